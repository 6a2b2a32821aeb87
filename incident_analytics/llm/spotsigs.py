"""Fingerprints from chains of content words behind common words, with DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

#: The most common function words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in a is that it for on was with be as by this are at an from or "
    "der die und das von zu den des mit sich auf ein eine ist im dem nicht als auch "
    "le la les et des un une du en que qui dans pour sur est par au avec "
    "el los las de y se por con una su para del lo como más"
).split()
#: Content words of a chain.
CHAIN = 2
#: Documents of a range of neighbours, and the most ranges whose ends go through the driver at once.
RANGE_ROWS, MOST_RANGES = 1000, 1000

_MARK = "\u0001"


def _words(text: Column) -> Column:
    """Lower-case words of letters and digits, a space before each and one at the end."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`, the sorted distinct hashes of the text's signatures.

    Common words are folded into marks; a signature is the next two content words behind a mark. A text
    without any mark before a content word takes each word as one that follows a mark. A text
    without words has no signature.
    """
    anchors = "|".join(sorted(set(ANCHORS)))
    plain, marked, found = f"_{out}_words", f"_{out}_marked", f"_{out}_found"
    one_space = F.regexp_replace(_words(F.col(text)), " +", " ")
    df = df.withColumn(plain, one_space)
    # A mark stands right before the next content word: " the of x y" becomes " \u0001x y".
    df = df.withColumn(marked, F.regexp_replace(plain, rf"(?: (?:{anchors})(?= ))++ ", f" {_MARK}"))
    df = df.withColumn(found, F.regexp_extract_all(marked, F.lit(rf"(?<= {_MARK})(?=([^ {_MARK}]+(?: {_MARK}?[^ {_MARK}]+){{0,{CHAIN - 1}}}))"), F.lit(1)))
    every = F.regexp_extract_all(plain, F.lit(rf"(?<= )(?=([^ ]+(?: [^ ]+){{0,{CHAIN - 1}}}))"), F.lit(1))
    signatures = F.when(F.size(found) > 0, F.col(found)).otherwise(every)
    hashes = F.transform(signatures, lambda s: F.xxhash64(F.translate(s, _MARK, "")))
    return df.withColumn(out, F.sort_array(F.array_distinct(hashes))).drop(plain, marked, found)


def fingerprint(signatures: Column) -> Column:
    """The signatures as text."""
    return F.array_join(signatures.cast("array<string>"), ",")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets, or 0 where their sizes already rule out `least`.

    Two empty sets are alike; an empty and a filled one are not.
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | (small < F.lit(least) * large), F.lit(0.0))
        .otherwise(common / (small + large - common))
    )


def _shares(parts: int) -> list[float]:
    return [i / parts for i in range(1, parts)] + [1.0]


def _range_ends(docs: DataFrame) -> tuple[list[int], int]:
    """Ids that end ranges of about equal row counts, the largest id included; and into how many parts each has to be cut."""
    rows = docs.select(F.count("doc_id").alias("n")).first()["n"]
    if not rows:
        return [], 1
    wanted = max(rows // RANGE_ROWS, 1)
    parts = min(wanted, MOST_RANGES)
    found = docs.select(F.percentile_approx("doc_id", _shares(parts), 10 * MOST_RANGES).alias("ends"), F.max("doc_id").alias("last")).first()
    return sorted({*found["ends"], found["last"]}), min(-(-wanted // parts), MOST_RANGES)


def _ranged(docs: DataFrame) -> DataFrame:
    """Adds _range, the number of the row's range of ids, _last, whether its id ends it, and _above, the next range's number.

    The ends of MOST_RANGES ranges go through the driver. Where that leaves more than RANGE_ROWS rows to each, every range is
    cut once more, by ends that are found within it; they go to all tasks, MOST_RANGES for each at most.
    """
    ends, parts = _range_ends(docs)
    if not ends:
        return docs.withColumns({"_range": F.lit(0), "_last": F.lit(True), "_above": F.lit(0)})
    doc_id, n = F.col("doc_id"), len(ends)
    table = F.array(*map(F.lit, ends)).cast("array<long>")
    at = F.when(doc_id.isNull(), F.lit(0)).otherwise(F.size(F.filter(table, lambda x: x < F.col("doc_id")))).cast("int")
    last = F.coalesce(F.array_contains(table, doc_id), F.lit(False))
    dealt = docs.withColumn("_range", at)
    if parts == 1:
        return dealt.withColumns({"_last": last, "_above": (F.col("_range") + 1) % n})
    cut = dealt.filter(doc_id.isNotNull()).groupBy(F.col("_range").alias("_part")).agg(
        F.percentile_approx("doc_id", _shares(parts), 10 * MOST_RANGES).alias("_found"), F.max("doc_id").alias("_most")
    )
    cut = cut.select("_part", F.array_sort(F.array_distinct(F.concat("_found", F.array("_most")))).alias("_ends"))
    joined = dealt.join(F.broadcast(cut), F.col("_range") == F.col("_part"), "left")
    inside = F.when(doc_id.isNull(), F.lit(0)).otherwise(F.size(F.filter("_ends", lambda x: x < F.col("doc_id"))))
    own = F.col("_range") * MOST_RANGES + inside
    above = F.when(last, (F.col("_range") + 1) % n * MOST_RANGES).otherwise(own + 1)
    ended = F.coalesce(F.array_contains("_ends", doc_id), F.lit(False))
    return joined.withColumns({"_last": ended, "_above": above.cast("int"), "_range": own.cast("int")}).drop("_part", "_ends")


def with_next(docs: DataFrame) -> tuple[DataFrame, WindowSpec]:
    """doc_id, text, whether the row is a guest, the text of the next document by descending doc_id; after the last comes the first,
    and the window that finds the next row.

    Rows go to ranges of ids of about equal row counts; the last row of each range is sent to the range
    above as well, as a guest, so that no range needs another. Equal ids go by text; null ids come last.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = _ranged(docs)
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_above").alias("range"), F.lit(True).alias("guest"))
    dealt = dealt.withColumn("_to", F.explode(F.when(F.col("_last"), F.array(own, guest)).otherwise(F.array(own))))
    order = Window.partitionBy("_range").orderBy("_guest", F.col("doc_id").desc_nulls_last(), "text")
    dealt = dealt.select("doc_id", "text", F.col("_to.range").alias("_range"), F.col("_to.guest").alias("_guest"))
    return dealt.withColumn("next_text", F.lead("text").over(order)), order


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likenesses.

    The edited text ends with the beginning of the next document instead of its own last third. Null
    text is empty; repeated rows follow one another. Texts are shuffled once.
    """
    near, order = with_next(docs)
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    signed = with_signatures(near.withColumn("_edited", F.coalesce(edited, F.lit(""))), "text", "_own")
    signed = with_signatures(signed, "_edited", "_new").withColumn("_next", F.lead("_own").over(order)).filter("not _guest")
    return signed.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint(F.col("_own")).alias("fingerprint"), fingerprint(F.col("_new")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_new")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )


def near_matches(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """Pairs (a, b, likeness), a < b, of fingerprint classes with a likeness of `least` or more.

    A class is named by the smallest doc_id of its rows; equal fingerprints are one class, and texts without
    signatures match nothing. Sets are partitioned by length: two sets that match lie in the same
    partition or in neighbouring ones, so each also goes to the next one as a guest. Within a
    partition only sets meet that share one of their rarest signatures, as many as a match must have in common
    with them (prefix filter), and the sizes decide before the Jaccard similarity is worked out.
    """
    signed = with_signatures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), "text", "_own")
    sets = signed.groupBy(F.col("_own").alias("sigs")).agg(F.min("doc_id").alias("id")).filter("size(sigs) > 0 and id is not null")
    single = sets.select("id", F.explode("sigs").alias("sig"))
    often = single.groupBy("sig").agg(F.count("*").alias("n"))
    ranked = single.join(often, "sig").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "sig"))).alias("ranked"))
    size = F.size("ranked")
    head = F.slice("ranked", F.lit(1), (size - F.ceil(size * F.lit(least) - 1e-9) + 1).cast("int"))
    own = F.floor(F.log(size.cast("double")) / F.lit(-math.log(least)) + 1e-9)
    keyed = ranked.join(sets, "id").select("id", "sigs", own.alias("part"), F.explode(F.transform(head, lambda r: r["sig"])).alias("sig"))
    # The smaller set comes as a guest from the partition below, or both are at home.
    home = keyed.select("part", "sig", F.col("id").alias("x"), F.col("sigs").alias("x_sigs"))
    guests = keyed.select(F.explode(F.array(F.struct("part", F.lit(False).alias("guest")), F.struct((F.col("part") + 1).alias("part"), F.lit(True).alias("guest")))).alias("p"), "sig", F.col("id").alias("y"), F.col("sigs").alias("y_sigs"))
    guests = guests.select("p.part", "p.guest", "sig", "y", "y_sigs")
    met = home.join(guests, ["part", "sig"]).filter(
        "(guest or x < y) and x <> y"
    ).filter(F.least(F.size("x_sigs"), F.size("y_sigs")) >= F.lit(least) * F.greatest(F.size("x_sigs"), F.size("y_sigs")))
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "x_sigs", "y_sigs").dropDuplicates(["a", "b"])
    return pairs.select("a", "b", likeness(F.col("x_sigs"), F.col("y_sigs"), least).alias("likeness")).filter(F.col("likeness") >= least)
