"""Personal data: base patterns, and spans that weak labelers and a classifier add; DataFrame operations only."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.shared import stored

#: Kinds in the order in which they are listed: the base ones, then those that only the classifier adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("contact", "secret", "number", "code")
KINDS = BASE + ADDED

#: The base patterns. Look-behinds and possessive runs leave the matches as they are and keep
#: the search linear: a run that can't match is read once and not from each of its characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)"

_RUN = "A-Za-z0-9@+._-"
#: Candidates of the added kinds: phone numbers written in groups, and runs with a digit or an at sign.
CANDIDATE = (
    r"(?<![0-9A-Za-z+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
    rf"|(?<![{_RUN}])(?=[A-Za-z+._-]*+[0-9@])[{_RUN}]{{4,}}(?<=[A-Za-z0-9])"
)
#: Gazetteers and cue words.
_MAIL = r"(?i)@(gmail|yahoo|hotmail|outlook|mail|example)|\.(com|org|net|edu|de|fr|es|uk)$"
_PLAIN = r"(?i)^(v?[0-9]{1,2}([.][0-9]{1,2}){1,2}|(19|20)[0-9]{2}([.-][0-9]{1,2}){0,2}|cc-?by.*|utf-?8|mp[34]|covid-?19)$"
_CUE = r"(?i)(token|key|secret|passw(or)?d|pin|e-?mail|contact|tel|telefon|phone|call|card|account|konto|compte|cuenta|iban|ssn|id|passport|address|adresse)[\x20\"':=#.]*$"
_OTHER_CUE = r"(?i)(version|licen[sc]e|page|chapter|section|figure|table|rfc|isbn|v|no|nr|\$|€|by)[\x20.:]*$"
#: Characters before a candidate in which cue words are looked for.
CONTEXT = 24


def _with_running(df: DataFrame, column: str, zero: Column, join: Callable[[Column, Column], Column], block: int = 64) -> DataFrame:
    """Replaces an integer array by join over each of its prefixes.

    Blocks first, then the blocks before each block, so the work stays near the length of the array.
    No lambda reads a column that stands only there: Spark would work it out anew for each element.
    """
    blocks, before = f"{column}_blocks", f"{column}_before"
    start = F.struct(zero.alias("now"), F.array().cast("array<int>").alias("all"))

    def step(acc: Column, x: Column) -> Column:
        now = join(acc["now"], x)
        return F.struct(now.alias("now"), F.concat(acc["all"], F.array(now)).alias("all"))

    def carry(acc: Column, part: Column) -> Column:
        last = F.coalesce(F.get(part, F.size(part) - 1), zero)
        return F.struct(join(acc["now"], last).alias("now"), F.concat(acc["all"], F.array(acc["now"])).alias("all"))

    parts = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(column) / block).cast("int")),
        lambda b: F.aggregate(F.slice(column, b * block + 1, block), start, step, lambda acc: acc["all"]),
    )
    df = df.withColumn(blocks, parts)
    df = df.withColumn(before, F.aggregate(blocks, start, carry, lambda acc: acc["all"]))
    whole = F.zip_with(blocks, before, lambda part, c: F.transform(part, lambda x: join(c, x)))
    return df.withColumn(column, F.flatten(whole)).drop(blocks, before)


def _with_matches(df: DataFrame, out: str, pattern: str, maybe: Column) -> DataFrame:
    """Adds `out`, the matches of `pattern` in text with their code point ranges and what stands before."""
    found, pieces, ends = f"{out}_found", f"{out}_pieces", f"{out}_ends"
    none = F.array().cast("array<string>")
    df = df.withColumn(found, F.when(maybe, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    split = F.split("text", pattern, -1)
    df = df.withColumn(pieces, F.when(F.size(found) > 0, F.slice(split, F.lit(1), F.size(found))).otherwise(none))
    df = df.withColumn(ends, F.zip_with(pieces, found, lambda p, m: F.char_length(p) + F.char_length(m)))
    df = _with_running(df, ends, F.lit(0), lambda a, b: a + b)
    zipped = F.arrays_zip(F.col(found).alias("found"), F.col(pieces).alias("piece"), F.col(ends).alias("end"))
    made = F.transform(
        zipped,
        lambda m: F.struct(
            (m["end"] - F.char_length(m["found"])).alias("start"), m["end"].alias("end"), m["found"].alias("found"),
            F.right(m["piece"], F.lit(CONTEXT)).alias("before"),
        ),
    )
    return df.withColumn(out, made).drop(found, pieces, ends)


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _span(rank: Column | int, match: Column) -> Column:
    rank = F.lit(rank) if isinstance(rank, int) else rank
    return F.struct(match["start"].alias("start"), rank.cast("int").alias("rank"), match["end"].alias("end"))


def _valid_spans(matches: Column, kind: str, rank: int) -> Column:
    return F.transform(F.filter(matches, lambda m: _valid(kind, m["found"])), lambda m: _span(rank, m))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_base(docs: DataFrame) -> DataFrame:
    """Adds `base`, the valid base spans (start, rank, end) of text in order."""
    df = docs
    digit = F.col("text").rlike("[0-9]")
    for rank, kind in enumerate(BASE):
        maybe = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+")}.get(kind, digit)
        df = _with_matches(df, f"_{kind}", PATTERNS[kind], maybe)
        df = df.withColumn(f"_{kind}", _valid_spans(F.col(f"_{kind}"), kind, rank))
    return df.withColumn("base", F.sort_array(F.concat(*(F.col(f"_{k}") for k in BASE)))).drop(*(f"_{k}" for k in BASE))


def _kind(found: Column) -> Column:
    """Rank of an added kind, from the shape of a candidate."""
    digits = F.length(F.regexp_replace(found, "[^0-9]", ""))
    letters = found.rlike("[A-Za-z]")
    return (
        F.when(found.contains("@"), F.lit(KINDS.index("contact")))
        .when(letters & (digits >= 4) & (F.length(found) >= 20), F.lit(KINDS.index("secret")))
        .when(~letters & (digits >= 7), F.lit(KINDS.index("number")))
        .otherwise(F.lit(KINDS.index("code")))
    )


def _votes(found: Column, before: Column) -> list[Column]:
    """What each labeler says: 1 personal, 0 not, 2 nothing."""
    digits = F.length(F.regexp_replace(found, "[^0-9]", ""))

    def says(yes: Column, no: Column) -> Column:
        return F.when(yes, F.lit(1)).when(no, F.lit(0)).otherwise(F.lit(2))

    shaped = r"^[0-9a-fA-F]{32,}$|^[^@]+@[^@]+\.[A-Za-z]+$|^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$|^[0-9]{13,19}$|^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"
    return [
        says(found.rlike(shaped), F.length(found) < 7),
        says(found.rlike(_MAIL), found.rlike(_PLAIN)),
        says(before.rlike(_CUE), before.rlike(_OTHER_CUE)),
        says(digits >= 9, digits < 5),
    ]


_LABELERS = 4


def _shape(found: Column) -> Column:
    """Class of a candidate by what its characters are: letter cases, digits, separators."""
    bits = [found.rlike("[A-Z]"), found.rlike("[a-z]"), found.rlike("[0-9]{4}"), found.rlike("[0-9][A-Za-z]|[A-Za-z][0-9]"), found.rlike(r"[\x20.+-]")]
    return sum((F.when(bit, F.lit(1 << i)).otherwise(F.lit(0)) for i, bit in enumerate(bits)), F.lit(0))


def _side(before: Column) -> Column:
    """Class of the character right before a candidate."""
    last = F.substring(F.rtrim(before), -1, 1)
    return (
        F.when(before == "", 0).when(last.isin(":", "="), 1).when(last.isin("'", '"', "`", "(", "[", "<", "{"), 2)
        .when(last.isin(".", "!", "?", ",", ";"), 3).otherwise(4)
    )


def _free(df: DataFrame) -> DataFrame:
    """Replaces `_near` by those of its matches that no span of `base` touches.

    Both lists are in order, so they are merged: a match is free if the spans that begin before it end before it, and the
    next span begins behind it. The work grows with the number of finds, not with its square.
    """
    both = (F.size("base") > 0) & (F.size("_near") > 0)
    event = lambda side, m, found, before: F.struct(m["start"].alias("start"), F.lit(side).alias("side"), m["end"].alias("end"), found.alias("found"), before.alias("before"))
    nothing = F.lit(None).cast("string")
    spans = F.transform("base", lambda b: event(0, b, nothing, nothing))
    matches = F.transform("_near", lambda m: event(1, m, m["found"], m["before"]))
    df = df.withColumn("_events", F.when(both, F.sort_array(F.concat(spans, matches))).otherwise(F.slice(matches, 1, 0)))
    far = F.lit((1 << 31) - 1)
    df = df.withColumn("_reach", F.transform("_events", lambda e: F.when(e["side"] == 0, e["end"]).otherwise(0)))
    df = df.withColumn("_next", F.reverse(F.transform("_events", lambda e: F.when(e["side"] == 0, e["start"]).otherwise(far))))
    df = _with_running(df, "_reach", F.lit(0), F.greatest)
    df = _with_running(df, "_next", far, F.least)
    zipped = F.arrays_zip(F.col("_events").alias("event"), F.col("_reach").alias("reach"), F.reverse("_next").alias("next"))
    alone = F.filter(zipped, lambda z: (z["event"]["side"] == 1) & (z["reach"] <= z["event"]["start"]) & (z["next"] >= z["event"]["end"]))
    kept = F.transform(alone, lambda z: F.struct(*(z["event"][c].alias(c) for c in ("start", "end", "found", "before"))))
    return df.withColumn("_near", F.when(both, kept).otherwise(F.col("_near"))).drop("_events", "_reach", "_next")


def with_candidates(docs: DataFrame) -> DataFrame:
    """Adds `candidates` (start, end, rank, size class, shape, side, votes) that no base span touches."""
    df = _free(_with_matches(docs, "_near", CANDIDATE, F.col("text").rlike("[0-9@]")))
    length = lambda m: F.least(F.floor(F.log2(F.length(m["found"]).cast("double"))), F.lit(6)).cast("int")
    made = F.transform(
        "_near",
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), _kind(m["found"]).alias("rank"), length(m).alias("length"),
            _shape(m["found"]).cast("int").alias("shape"), _side(m["before"]).cast("int").alias("side"),
            *(v.cast("int").alias(f"v{i}") for i, v in enumerate(_votes(m["found"], m["before"]))),
        ),
    )
    return df.withColumn("candidates", made).drop("_near")


@dataclass(frozen=True)
class Model:
    """Log-odds of the classifier: a constant, and one per feature and value; reliabilities[labeler][truth][vote]."""

    constant: float
    weights: dict[str, dict[int, float]]
    reliabilities: list

    def score(self, candidate: Column) -> Column:
        total = F.lit(self.constant)
        for name, table in self.weights.items():
            cases = F.create_map(*(x for k, v in table.items() for x in (F.lit(k), F.lit(v))))
            total = total + F.coalesce(F.try_element_at(cases, candidate[name]), F.lit(0.0))
        return total


#: What the classifier sees of a candidate besides the votes: its text's and its neighbour's classes can outweigh them.
FEATURES = ("rank", "length", "shape", "side")


def estimate(rows: Iterable[tuple], rounds: int = 50, prior: float = 0.3) -> Model:
    """Reliabilities of the labelers by expectation-maximisation, and a classifier trained on its posteriors.

    rows: (votes, classes in order of FEATURES, count). There are as many of them as combinations of votes and
    classes at most, whatever the number of documents. A labeler starts as right more often than not, so the
    two sides don't swap.
    """
    rows = [(votes, features, n) for votes, *features, n in rows]
    share = prior
    says = [[[0.6, 0.1, 0.3], [0.1, 0.6, 0.3]] for _ in range(_LABELERS)]

    def posterior(votes: tuple[int, ...]) -> float:
        odds = math.log(share) - math.log(1 - share)
        for i, v in enumerate(votes):
            odds += math.log(says[i][1][v]) - math.log(says[i][0][v])
        return 1 / (1 + math.exp(-max(min(odds, 50), -50)))

    for _ in range(rounds):
        seen = [[[1.2, 0.2, 0.6], [0.2, 1.2, 0.6]] for _ in range(_LABELERS)]
        yes, total = 1.0, 2.0
        for votes, _, n in rows:
            p = posterior(votes)
            yes, total = yes + n * p, total + n
            for i, v in enumerate(votes):
                seen[i][1][v] += n * p
                seen[i][0][v] += n * (1 - p)
        share = yes / total
        says = [[[x / sum(side) for x in side] for side in one] for one in seen]
    names = [*(f"v{i}" for i in range(_LABELERS)), *FEATURES]
    tables: dict[str, dict[int, list[float]]] = {name: defaultdict(lambda: [0.5, 0.5]) for name in names}
    both = [1.0, 1.0]
    for votes, features, n in rows:
        p = posterior(votes)
        for name, value in zip(names, (*votes, *features), strict=False):
            tables[name][value][1] += n * p
            tables[name][value][0] += n * (1 - p)
        both[1] += n * p
        both[0] += n * (1 - p)
    weights = {
        name: {k: math.log(one / both[1]) - math.log(zero / both[0]) for k, (zero, one) in table.items()}
        for name, table in tables.items()
    }
    return Model(math.log(both[1]) - math.log(both[0]), {k: v for k, v in weights.items() if v}, says)


def _found(docs: DataFrame) -> DataFrame:
    return with_candidates(with_base(docs.withColumn("text", F.coalesce("text", F.lit("")))))


def _trained(found: DataFrame) -> Model:
    columns = [*(f"v{i}" for i in range(_LABELERS)), *FEATURES]
    counts = found.select(F.explode("candidates").alias("c")).select("c.*").groupBy(*columns).count().collect()
    return estimate([(tuple(r[f"v{i}"] for i in range(_LABELERS)), *(r[f] for f in FEATURES), r["count"]) for r in counts])


def train(docs: DataFrame) -> Model:
    """The model of all candidates of the documents; only counts per vote pattern reach the driver."""
    return _trained(_found(docs.select("text")))


def _with_spans(found: DataFrame, model: Model | None) -> DataFrame:
    """Adds `spans`; without a model, the one of these rows, which are then searched once and kept for it."""
    if model is None:
        found = stored(found)
        model = _trained(found)
    added = F.transform(F.filter("candidates", lambda c: model.score(c) > 0), lambda c: _span(c["rank"], c))
    return found.withColumn("spans", F.sort_array(F.concat("base", added))).drop("candidates")


def with_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Adds `base` and `spans`, arrays of (start, rank, end) in order, to documents with text (null: empty).

    Spans of different kinds may overlap, as the base patterns are searched apart.
    """
    return _with_spans(_found(docs), model)


def personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, base counts, the digest of the base spans and the list of all spans of each row.

    A null or empty text has no spans. Rows are searched alone; repeated rows get equal results, and count in the model
    as often as they stand there.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = _with_spans(_found(read).drop("text"), model)
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(BASE)),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with [EMAIL], [IP], ... instead of their spans; other columns stay.

    Of spans that overlap, the first gives the name and all are taken out. Null text stays null.
    """
    columns = docs.columns
    row = F.struct(F.col("text").isNull().alias("null text"), *(F.col(f"`{c}`") for c in columns if c != "text")).alias("_row")
    found = _with_spans(_found(docs.select(row, "text")), model)
    found = found.withColumn("_ends", F.transform("spans", lambda s: s["end"]))
    found = _with_running(found, "_ends", F.lit(0), F.greatest)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def part(span: Column, i: Column) -> Column:
        reached = F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_ends"), i - 1))
        kept = F.substring("text", reached + 1, F.greatest(span["start"] - reached, F.lit(0)))
        return F.when(span["start"] >= reached, F.concat(kept, F.get(names, span["rank"]))).otherwise(F.lit(""))

    rest = F.substring("text", F.coalesce(F.array_max("_ends"), F.lit(0)) + 1, F.char_length("text"))
    clean = F.when(F.size("spans") > 0, F.concat(F.array_join(F.transform("spans", part), ""), rest)).otherwise(F.col("text"))
    clean = F.when(~F.col("_row")["null text"], clean)
    return found.withColumn("_clean", clean).select(*(F.col("_clean").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in columns))
