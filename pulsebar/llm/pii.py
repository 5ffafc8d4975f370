"""Personal data by candidate gradient boosting.

Fixed patterns with checks (email, ip, card, phone) give the base spans. They read a text once from
the left, so a card right after a phone number, or an address with spaces, escapes them. High-recall
generators therefore propose further spans, overlapping ones too. Boosted trees (Spark ML) judge
them by format and context; they are trained on base spans against the same spans with their
format broken and against proposals that fail the check of their kind. A quarter of all spans, by hash, is held out
of training. Scored by the trees, all of that quarter, with broken forms and refused proposals, gives each
kind the lowest threshold that keeps ``precision``; a kind that reaches it nowhere adds nothing.
Base spans always stay, and a candidate that meets one is not added.

Only the trees are fitted on a sample: at most ``most_rows`` spans and as many refused proposals a kind (the smallest
hashes of the other three quarters), so that many spans of one kind don't crowd out a rare one. Spans that share kind, text and
surroundings count once.

Defined cases: null and empty texts have no spans; repeated rows are reported each; without base
spans no model is trained and nothing is added; an empty table gives none. Places are code points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsebar.llm.common import stored, text_of

KINDS = ("email", "ip", "card", "phone")
MOST_ROWS = 20_000
PRECISION = 0.95
_LOCAL = "[A-Za-z0-9._%+-]"
#: A match starts where the last ended or its first run of characters starts, so no run is read twice.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Every repeat is bounded, so that a long run of digits or letters is read in linear time.
PROPOSED = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}"
        r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}){1,8}"
    ),
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?\[?\.\]?\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[\x20.-]?){3}[0-9]{4}(?:[\x20.-]?[0-9]{1,3})?(?![0-9])",
    "phone": r"(?<![0-9])\+?(?:[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
}
_NEEDED = {"email": "@|\\(at\\)|\\[at\\]", "ip": "[0-9]\\x20?\\[?\\.", "card": "[0-9][\\x20.-]?[0-9]", "phone": "[0-9][\\x20.-]?[0-9]"}
#: What each base pattern implies; a base phone needs no two digits near each other.
_NEEDED_BASE = _NEEDED | {"phone": "\\+[0-9]"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_PROPOSAL = "array<struct<kind:int,base:boolean,nth:int,gap:int,span:string,before:string,after:string>>"


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum is a multiple of ten."""
    values = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)), lambda d: d.cast("int"))
    doubled = F.transform(values, lambda d, k: F.when(k % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def passes(kind: Column, span: Column) -> Column:
    """The check of each kind (0 to 3, as in KINDS)."""
    count = F.char_length(_digits(span))
    return (
        F.when(kind == 1, span.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
        .when(kind == 2, F.when(count.between(16, 19), luhn(_digits(span))).otherwise(False))
        .when(kind == 3, count.between(8, 15))
        .otherwise(True)
    )


def _found(text: Column, kind: int, base: bool) -> Column:
    """Matches in order, each with the characters since the one before and some of what stands around."""
    pattern = F.lit((BASE if base else PROPOSED)[KINDS[kind]])
    gaps = F.split(text, pattern, -1)

    def one(span: Column, k: Column) -> Column:
        gap = F.get(gaps, k)
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(base).alias("base"), k.alias("nth"), F.char_length(gap).alias("gap"),
            span.alias("span"), F.right(gap, F.lit(16)).alias("before"), F.left(F.get(gaps, k + 1), F.lit(16)).alias("after"),
        )

    spans = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), one).cast(_PROPOSAL)
    return F.when(text.rlike((_NEEDED_BASE if base else _NEEDED)[KINDS[kind]]), spans).otherwise(F.array().cast(_PROPOSAL))


def proposals(docs: DataFrame) -> DataFrame:
    """row, doc_id, text_sha256 and every match of the patterns and generators in the whole text."""
    read = docs.select("doc_id", text_of().alias("text"))
    every = [_found(F.col("text"), kind, base) for base in (True, False) for kind in range(len(KINDS))]
    return read.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("text", 256).alias("text_sha256"), F.concat(*every).alias("found")
    )


def placed(proposed: DataFrame) -> DataFrame:
    """row, kind, base, start, end, span, before, after: a running sum in each text gives the places."""
    rows = proposed.select("row", F.explode("found").alias("f")).select("row", "f.*")
    order = Window.partitionBy("row", "base", "kind").orderBy("nth")
    until = F.sum(F.col("gap") + F.char_length("span")).over(order)
    return rows.select(
        "row", "kind", "base", (until - F.char_length("span")).alias("start"), until.alias("end"), "span", "before", "after"
    )


def features(span: Column, kind: Column, before: Column, after: Column) -> dict[str, Column]:
    """Format of the span and what stands beside it."""

    def count(of: Column, pattern: str) -> Column:
        return F.regexp_count(of, F.lit(pattern)).cast("double")

    digits = _digits(span)
    yes = {f"kind_{name}": kind == k for k, name in enumerate(KINDS)}
    yes |= {
        "luhn": F.when(F.char_length(digits).between(12, 19), luhn(digits)).otherwise(False),
        "octets": F.regexp_replace(span, r"[\x20\[\]]", "").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "plus": span.startswith("+"), "dotted_name": span.rlike(r"@.*[.][A-Za-z]{2,}$"),
        "joined_before": before.rlike("[A-Za-z0-9]$"), "joined_after": after.rlike("^[A-Za-z0-9]"),
        "digit_before": before.rlike("[0-9][^A-Za-z0-9]*$"), "digit_after": after.rlike("^[^A-Za-z0-9]*[0-9]"),
        "dot_before": before.endswith("."), "dot_after": after.rlike("^[.][0-9]"),
    }
    numbers = {
        "chars": F.char_length(span).cast("double"), "digits": F.char_length(digits).cast("double"),
        "letters": count(span, "[A-Za-z]"), "spaces": count(span, r"\x20"), "dots": count(span, "[.]"),
        "hyphens": count(span, "-"), "brackets": count(span, r"[()\[\]]"), "groups": count(span, "[0-9]+"), "at": count(span, "@"),
    }
    return {name: flag.cast("double") for name, flag in yes.items()} | numbers


def broken(kind: Column, span: Column) -> Column:
    """The span with its format broken, as an example of what is no personal data of its kind."""
    last = F.right(span, F.lit(1))
    return (
        F.when(kind == 0, F.substring_index(span, ".", 1))
        .when(kind == 1, F.concat(F.lit("9"), F.lpad(F.substring_index(span, ".", 1), 2, "9"), F.lit("."), F.substring_index(span, ".", -3)))
        .when(kind == 2, F.concat(F.left(span, F.char_length(span) - 1), F.pmod(last.try_cast("int") + 1, F.lit(10)).cast("string")))
        .otherwise(F.left(F.regexp_replace(span, r"^\+", ""), F.lit(7)))
    )


def _with_features(rows: DataFrame) -> DataFrame:
    own = features(F.col("span"), F.col("kind"), F.col("before"), F.col("after"))
    rows = rows.select("*", *[column.alias(f"x_{name}") for name, column in own.items()])
    names = [f"x_{name}" for name in own]
    return VectorAssembler(inputCols=names, outputCol="x", handleInvalid="keep").transform(rows).drop(*names)


def _examples(spans: DataFrame) -> DataFrame:
    """Each base span as it is (``y`` 1) and with its format broken (0); refused proposals as they are (0)."""
    right = F.col("right")
    both = spans.select("*", F.explode(F.when(right, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0)))).alias("y"))
    return both.withColumn(
        "span", F.when(right & (F.col("y") == 0), broken(F.col("kind"), F.col("span"))).otherwise(F.col("span"))
    )


def fit(base: DataFrame, refused: DataFrame, most_rows: int = MOST_ROWS, precision: float = PRECISION):
    """The trees and each kind's threshold; None without examples.

    ``base`` has spans that are right, ``refused`` proposals that are not.
    """
    given = [frame.select("kind", "span", "before", "after", F.lit(right).alias("right")) for frame, right in ((base, True), (refused, False))]
    every = given[0].unionByName(given[1]).distinct().withColumn("held", F.pmod(F.xxhash64("span"), F.lit(4)) == 0)
    every = stored(every, "distinct-spans")
    order = F.xxhash64("span", "before", "after"), "span", "before", "after"
    samples = [
        every.where(~F.col("held") & (F.col("kind") == kind) & (F.col("right") == right)).orderBy(*order).limit(most_rows)
        for kind in range(len(KINDS)) for right in (True, False)
    ]
    learn = stored(_with_features(_examples(reduce(DataFrame.unionByName, samples))).select("x", "y"), "pii-examples")
    if learn.select("y").distinct().count() < 2:
        return None
    model = GBTClassifier(
        featuresCol="x", labelCol="y", maxDepth=3, maxIter=8, stepSize=0.3, maxBins=32, checkpointInterval=-1, seed=7
    ).fit(learn.coalesce(2))
    tested = judged(model, _with_features(_examples(every.where("held")))).withColumn("score", F.floor(F.col("score") * 50) / 50)
    above = Window.partitionBy("kind").orderBy(F.desc("score"))
    counts = tested.groupBy("kind", "score").agg(F.sum("y").alias("right"), F.count("*").alias("all"))  # 51 rows a kind at most
    sums = counts.select("kind", "score", (F.sum("right").over(above) / F.sum("all").over(above)).alias("precision"))
    rows = sums.where(F.col("precision") >= precision).groupBy("kind").agg(F.min("score").alias("cut")).collect()
    return model, {kind: max(cut, 0.5) for kind, cut in rows}


def judged(model, rows: DataFrame) -> DataFrame:
    out = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return out.drop("rawPrediction", "probability", "prediction")


def find_personal_data(docs: DataFrame, most_rows: int = MOST_ROWS, precision: float = PRECISION) -> DataFrame:
    """doc_id, text_sha256 and ``spans``: (kind, start, end, base) by kind, start and end."""
    proposed = stored(proposals(docs), "proposals")
    spans = placed(proposed)
    base = stored(spans.where("base").where(passes(F.col("kind"), F.col("span"))), "base-spans")
    refused = spans.where("NOT base").where(~passes(F.col("kind"), F.col("span")))
    fitted = fit(base, refused, most_rows, precision)
    found = base.select("row", "kind", "start", "end", "base")
    if fitted is not None and fitted[1]:
        model, cuts = fitted
        cut = F.coalesce(*[F.when(F.col("kind") == k, F.lit(c)) for k, c in cuts.items()], F.lit(2.0))
        likely = judged(model, _with_features(spans.where("NOT base"))).where(F.col("score") >= cut)
        both = found.unionByName(likely.select("row", "kind", "start", "end", "base"))
        # A candidate that meets a base span is left out: one before it reaches past its start, or one starts before its end.
        order = Window.partitionBy("row").orderBy("start", F.desc("base"))
        reach = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
        following = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
        clear = (F.coalesce(reach, F.lit(-1)) <= F.col("start")) & (F.coalesce(following >= F.col("end"), F.lit(True)))
        found = both.withColumn("clear", clear).where("base OR clear").drop("clear")
    listed = found.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "end", "base"))).alias("spans"))
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,base:boolean>>")
    rows = proposed.select("row", "doc_id", "text_sha256").join(listed, "row", "left")
    return rows.select("doc_id", "text_sha256", F.coalesce("spans", empty).alias("spans"))


def redact(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents that ``spans`` has, their spans' characters replaced by the kind.

    Spans that overlap are replaced as one, by the kind of the first and longest. Documents meet their
    spans by doc_id (null too) and text; rows that repeat both have the same spans and stay as many.
    """
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s.start.alias("start"), (-s.end).alias("back"), s.kind.alias("kind"))))
    names = F.array(*[F.lit(f"[{name}]") for name in KINDS])
    text = F.col("doc.text")

    def step(a: Column, s: Column) -> Column:
        kept = F.substring(text, (a["until"] + 1).cast("int"), (s["start"] - a["until"]).cast("int"))
        longer = F.struct(a["out"].alias("out"), F.greatest(a["until"], -s["back"]).alias("until"))
        further = F.struct(F.concat(a["out"], kept, F.get(names, s["kind"])).alias("out"), (-s["back"]).alias("until"))
        return F.when(s["start"] < a["until"], longer).otherwise(further)

    begun = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("until"))
    redacted = F.aggregate(
        order, begun, step, lambda a: F.concat(a["out"], F.substring(text, (a["until"] + 1).cast("int"), F.char_length(text)))
    )
    keyed = spans.select(F.col("doc_id").alias("of_id"), F.col("text_sha256").alias("of_text"), "spans")
    keyed = stored(keyed.dropDuplicates(["of_id", "of_text"]), "redact-spans")
    given = docs.select(F.struct("*").alias("doc"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("of_id")) & (F.sha2(F.coalesce("doc.text", F.lit("")), 256) == F.col("of_text"))
    return given.join(keyed, same).select(
        *[redacted.alias("text") if name == "text" else F.col(f"doc.`{name}`") for name in docs.columns]
    )
