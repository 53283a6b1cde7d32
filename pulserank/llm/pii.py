"""Personal data: candidate spans, boosted trees over their format and context, calibrated thresholds.

Base spans follow fixed patterns with checks. Beside them generous generators propose overlapping spans:
runs of digits with usual separators, and addresses spelled with "at" and "dot". Gradient boosted
trees score each proposal by its format and by the words around it; the checks of the base (Luhn, ranges, the plus sign) are not among the
features. Three kinds of examples teach them:

* Personal data: proposals of digits that overlap a base span, and base addresses rewritten with "at" and "dot" in their real context.
* Other numbers: proposals without a base span next to a word for numbers ("order", "page") and none for people, and spelled ones without a word for mail.
* Unlabelled: all other proposals. They may be personal data, so they train the trees as the second kind with a
  tenth of the weight and are left out of the calibration.

A fixed set of made-up examples (``prior``) joins those of the corpus, so a small corpus has a model and thresholds too. Each generator has its own
threshold, set on examples that the trees have not seen. A proposal above it that overlaps no base span is added with kind ``other``.

All of it is DataFrame operations in the JVM. The trees and the thresholds come from all distinct proposals of the corpus;
every text is searched whole and every proposal is scored.

Patterns repeat groups possessively, which Java runs as a loop: a text of a million digits needs no stack. Where
that skips only starts that would end in the same failure, a pattern starts at the border of a run, so no
run is searched from each of its characters.
"""
from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulserank.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")
OTHER = "other"
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "digits": r"(?<![A-Za-z0-9])[+(]?[0-9](?:[\x20().:/-]{0,2}[0-9]){5,30}+(?![A-Za-z0-9])",
    "spelled": r"(?i)(?<![a-z0-9])[a-z0-9._-]{1,64}+\x20?[(\[]?\x20?at\x20?[)\]]?\x20?[a-z0-9-]{1,64}+\x20?[(\[]?\x20?dot\x20?[)\]]?\x20?[a-z]{2,10}(?![a-z0-9])",
}
BEFORE, AFTER = 40, 20
CONTEXT = {
    "phone_word": r"(?i)\b(phone|tel|telephone|call|mobile|cell|fax|whatsapp|sms)\b",
    "card_word": r"(?i)\b(card|visa|mastercard|amex|credit|debit|iban|account|konto|carte|tarjeta)\b",
    "mail_word": r"(?i)\b(mail|email|e-mail|contact|write|reach|address)\b",
    "id_word": r"(?i)\b(ssn|passport|license|licence|birth|born|dob|social|tax|ident\w*)\b",
    "number_word": r"(?i)\b(version|order|invoice|page|isbn|issn|doi|error|line|port|id|ref|no|nr|number|total|price)\b",
}
#: Fixed: common ends of addresses, spelled out.
TOP = r"(?i)dot\W*(?:com|org|net|edu|gov|info|io|co|eu|de|fr|es|uk|us)\W*$"
PRECISION = 0.95
_PEOPLE = "(?i)" + "|".join(CONTEXT[k][4:] for k in ("phone_word", "card_word", "id_word"))
KEY = ["doc_id", "text_hash"]


def _luhn(digits: Column) -> Column:
    """Whether at most 19 digits pass Luhn's check."""
    padded = F.lpad(digits, 19, "0")
    total = F.lit(0)
    for place in range(19):
        digit = F.substring(padded, place + 1, 1).cast("int")
        total = total + (digit if place % 2 == 0 else F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2))
    return total % 10 == 0


def _passes(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    part = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
        .when(kind == "card", F.length(digits).between(16, 19) & _luhn(digits))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .otherwise(True)
    )


def proposals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, kind, start, end, value, before, after, base): base matches that pass, and generated spans.

    Positions count code points, ``end`` is exclusive. A text is cut at the matches of each pattern; positions are sums of the
    lengths of pieces, which leave the scan as numbers, so texts are not shuffled.
    """
    body = F.col("__text")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    spelled = body.rlike("(?i)dot") & body.rlike(GENERATORS["spelled"])
    rows = rows.where(body.rlike(r"[0-9@]") | spelled)
    patterns = {**BASE, **GENERATORS}
    has_digit, has_at = body.rlike("[0-9]"), F.contains(body, F.lit("@"))
    needed = {k: has_digit for k in patterns} | {"email": has_at, "phone": F.contains(body, F.lit("+")), "spelled": spelled}
    cut = F.array(*(
        F.when(needed[k], F.struct(F.lit(k).alias("kind"), F.split(body, p, -1).alias("pieces"), F.regexp_extract_all(body, F.lit(p), F.lit(0)).alias("found")))
        for k, p in patterns.items()
    ))
    parts = rows.select("doc_id", F.xxhash64("__text").alias("text_hash"), F.explode(cut).alias("c")).where("size(c.found) > 0")
    zipped = F.arrays_zip(F.col("c.pieces").alias("piece"), F.col("c.found").alias("value"), F.expr("slice(c.pieces, 2, size(c.pieces))").alias("next"))
    each = parts.select("doc_id", "text_hash", F.col("c.kind").alias("kind"), F.posexplode(zipped).alias("place", "m")).select(
        "doc_id", "text_hash", "kind", "place", F.length("m.piece").alias("gap"), F.col("m.value").alias("value"),
        F.right("m.piece", F.lit(BEFORE)).alias("before"), F.left("m.next", F.lit(AFTER)).alias("after"),
    ).where("value IS NOT NULL")
    once = each.groupBy("doc_id", "text_hash", "kind", "place").agg(*(F.first(c).alias(c) for c in ("gap", "value", "before", "after")))  # equal rows are one
    length = F.length("value")
    ends = F.expr("sum(gap + length(value)) OVER (PARTITION BY doc_id, text_hash, kind ORDER BY place)")
    placed = once.withColumn("end", ends.cast("int")).withColumn("start", F.col("end") - length)
    base = F.col("kind").isin(*KINDS)
    return placed.where(_passes(F.col("kind"), F.col("value"))).select(*KEY, "kind", "start", "end", "value", "before", "after", base.alias("base"))


def _features(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    around = F.concat_ws(" ", before, after)

    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)).cast("double")

    made = {
        "f_length": F.length(F.ltrim(value, F.lit("+"))).cast("double"), "f_digits": count("[0-9]"), "f_dots": count(r"\."), "f_spaces": count(" "),
        "f_dashes": count("-"), "f_brackets": count(r"[()]"), "f_slashes": count("[/:]"), "f_groups": count("[0-9]+"),
        "f_longest": F.array_max(F.transform(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)), lambda x: F.length(x))).cast("double"),
        "f_letters": count("[A-Za-z]"), "f_line_start": (F.trim(before) == "").cast("double"), "f_colon_before": before.rlike(r"[:=]\s*$").cast("double"),
        "f_word_before": before.rlike(r"[A-Za-z]\s$").cast("double"), "f_word_after": after.rlike(r"^[ ,.;]*[A-Za-z]").cast("double"),
        "f_digits_near": F.regexp_count(around, F.lit("[0-9]")).cast("double"),
        **{f"f_{k}": around.rlike(p).cast("double") for k, p in CONTEXT.items()},
    }
    # What a spelled address looks like does not tell by its name's digits or length, but by how it ends.
    plain = ("f_length", "f_digits", "f_dots", "f_dashes", "f_groups", "f_longest", "f_letters")
    made |= {n: F.when(F.col("kind") == "spelled", 0.0).otherwise(made[n]) for n in plain}
    made["f_top"] = value.rlike(TOP).cast("double")
    return rows.withColumns({n: F.coalesce(c, F.lit(0.0)) for n, c in made.items()}), list(made)


def _marked(found: DataFrame) -> DataFrame:
    """Generated spans with ``hit``: whether they overlap a base span of their text. One pass in order of position per text."""
    place = F.when(F.col("base"), F.col("start")).otherwise(F.col("end"))
    before = Window.partitionBy(*KEY).orderBy(place, F.col("base").cast("int")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(before)  # of base spans that start before this one ends
    return found.withColumn("hit", F.coalesce(reach > F.col("start"), F.lit(False))).where("NOT base")


_EXAMPLE = ("kind", "value", "before", "after", "label", "sure")


def _examples(marked: DataFrame, found: DataFrame) -> DataFrame:
    """(kind, value, before, after, label, sure): distinct proposals, and base addresses rewritten as people spell them."""
    around = F.concat_ws(" ", "before", "after")
    number = around.rlike(CONTEXT["number_word"]) & ~around.rlike(_PEOPLE)
    sure = F.col("hit") | F.when(F.col("kind") == "spelled", ~around.rlike(CONTEXT["mail_word"])).otherwise(number)
    own = marked.select("kind", "value", "before", "after", F.col("hit").cast("double").alias("label"), sure.alias("sure"))
    name, host = F.split_part("value", F.lit("@"), F.lit(1)), F.split_part("value", F.lit("@"), F.lit(2))
    dotted = F.concat_ws(" ", name, F.lit("at"), F.split_part(host, F.lit("."), F.lit(1)), F.lit("dot"), F.split_part(host, F.lit("."), F.lit(-1)))
    mail = found.where("kind = 'email'").select(F.lit("spelled").alias("kind"), dotted.alias("value"), "before", "after", F.lit(1.0).alias("label"), F.lit(True).alias("sure"))
    mail = mail.where(F.col("value").rlike(f"^(?:{GENERATORS['spelled']})$"))
    return own.unionByName(mail).groupBy("kind", "value", "before", "after").agg(F.max("label").alias("label"), F.max("sure").alias("sure"))


def prior(spark) -> DataFrame:
    """Made-up examples in the form of :func:`_examples`: 40 of each sentence, with numbers by a rule."""
    n = F.lpad((F.col("id") * 7919 % 9_000_000 + 1_000_000).cast("string"), 7, "0")
    phone = F.concat(F.lit("1 (555) "), F.left(n, F.lit(3)), F.lit("-"), F.right(n, F.lit(4)))
    card = F.concat_ws(" ", F.lit("4000"), F.left(n, F.lit(4)), F.right(n, F.lit(4)), F.lpad(F.col("id").cast("string"), 4, "3"))
    name = F.concat(F.lit("reader"), F.col("id").cast("string"))
    sentences = [
        ("digits", phone, "please call my phone ", " today", 1.0), ("digits", phone, "Tel: ", "", 1.0), ("digits", card, "my credit card is ", " until May", 1.0),
        ("digits", n, "order number ", " was sent", 0.0), ("digits", F.concat(F.lit("2023/"), n), "the invoice ", " is paid", 0.0), ("digits", n, "see page ", ", line 4", 0.0),
        ("digits", n, "it grew by ", " in a year", 0.0), ("digits", F.concat_ws("-", F.lit("2021"), F.left(n, F.lit(2)), F.right(n, F.lit(2))), "since ", " nothing changed", 0.0),
        ("spelled", F.concat(name, F.lit(" at example dot org")), "write to me: ", "", 1.0), ("spelled", F.concat(name, F.lit(" at example dot com")), "my email is ", " for now", 1.0),
        ("spelled", F.concat(name, F.lit(" at example dot net")), "or by mail to ", "\n", 1.0), ("spelled", F.concat(F.lit("glance at any dot "), F.lit("in")), "at first ", "\n", 0.0),
        ("spelled", F.concat(F.lit("looked at the dot "), F.lit("on")), "he ", " the wall", 0.0), ("spelled", F.concat(F.lit("stop at each dot "), F.lit("and")), "the lines ", " go on", 0.0),
    ]
    rows = None
    for kind, value, before, after, label in sentences:
        part = spark.range(40).select(F.lit(kind).alias("kind"), value.alias("value"), F.lit(before).alias("before"), F.lit(after).alias("after"), F.lit(label).alias("label"), F.lit(True).alias("sure"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def added_spans(found: DataFrame, precision: float = PRECISION) -> DataFrame:
    """The generated spans that the trees accept and no base span overlaps.

    All distinct examples of the corpus and those of :func:`prior` are used. Three quarters train the trees; among the sure ones of the
    rest the threshold of each generator is the lowest from 0.5 to 1 from which on at least ``precision`` of the accepted are personal data.
    """
    marked = materialise(_marked(found), "pii-proposals")
    spark = found.sparkSession
    code = F.xxhash64("kind", "value", "before", "after")
    weight = F.when(F.col("sure"), 1.0).otherwise(0.1)
    sample, names = _features(_examples(marked, found).unionByName(prior(spark)).withColumn("fold", F.pmod(code, F.lit(4))))
    sample = materialise(sample.select("kind", "label", "sure", "fold", weight.alias("weight"), *names), "pii-sample")
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(maxIter=10, maxDepth=4, stepSize=0.3, seed=5, featuresCol="features", labelCol="label", weightCol="weight")
    model = trees.fit(assembler.transform(sample.where("fold > 0")).select("features", "label", "weight"))

    def scored(df: DataFrame) -> DataFrame:
        out = model.transform(assembler.transform(df))
        return out.withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")

    bins = scored(sample.where("fold = 0 AND sure")).groupBy("kind", F.floor(F.col("p") * 50).alias("bin")).agg(F.sum("label").alias("hits"), F.count("*").alias("n")).collect()
    limits = {}
    for kind in GENERATORS:
        counts, hits, n = {b.bin: (b.hits, b.n) for b in bins if b.kind == kind}, 0.0, 0
        for place in range(50, 24, -1):  # never below one half
            hits, n = hits + counts.get(place, (0, 0))[0], n + counts.get(place, (0, 0))[1]
            if n and hits >= precision * n:
                limits[kind] = place / 50
    limit = F.lit(2.0)  # above every score
    for kind, value in limits.items():
        limit = F.when(F.col("kind") == kind, value).otherwise(limit)
    new = scored(_features(marked.where("NOT hit"))[0]).where(F.col("p") >= limit)
    return new.select(*KEY, F.lit(OTHER).alias("kind"), "start", "end", "value", "before", "after", F.lit(False).alias("base"))


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_hash: bool = False) -> DataFrame:
    """(doc_id, spans, base): a row per row of ``docs``; spans are arrays of (rank, start, end, kind), sorted.

    ``base`` are the spans of the fixed patterns, ``spans`` those and the accepted proposals; ``rank`` orders the kinds. Null and
    empty texts have none. Rows without an id are searched like others, repeated rows get equal results, other columns
    are ignored, an empty table gives an empty result.
    """
    found = materialise(proposals(docs, doc_id, text), "pii-spans")
    base = found.where("base")
    every = base.unionByName(added_spans(found))
    rank = F.array_position(F.array(*(F.lit(k) for k in (*KINDS, OTHER))), F.col("kind")).cast("int")
    span = F.struct(rank.alias("rank"), "start", "end", "kind")
    by_text = every.distinct().groupBy(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).agg(F.array_sort(F.collect_list(span)).alias("spans"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text_hash"))
    joined = rows.join(by_text, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__t")), "left")
    none = F.array().cast("array<struct<rank:int,start:int,end:int,kind:string>>")
    spans = F.coalesce("spans", none)
    return joined.select("doc_id", *(["text_hash"] if keep_hash else []), spans.alias("spans"), F.filter(spans, lambda s: s["kind"] != OTHER).alias("base"))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, redacted): every row's text with its spans replaced by ``[KIND]``; of overlapping spans the first one is replaced whole.

    Rows without an id and rows of one id with other texts are cut at their own spans; null texts become empty.
    """
    spans = find_pii(docs, doc_id, text, keep_hash=True).dropDuplicates(["doc_id", "text_hash"]).select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"), "spans")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body")).withColumn("text_hash", F.xxhash64("body"))
    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__t")))
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(state, span):
        fresh = span["start"] >= state["end"]
        gap = F.substring(F.col("body"), state["end"] + 1, span["start"] - state["end"])
        return F.when(
            fresh, F.struct(span["end"].alias("end"), F.concat(state["out"], gap, F.lit("["), F.upper(span["kind"]), F.lit("]")).alias("out"))
        ).otherwise(F.struct(F.greatest(state["end"], span["end"]).alias("end"), state["out"].alias("out")))

    start = F.struct(F.lit(0).alias("end"), F.lit("").alias("out"))
    done = F.aggregate(order, start, step, lambda s: F.concat(s["out"], F.substring(F.col("body"), s["end"] + 1, F.length("body"))))
    return joined.select("doc_id", done.alias("redacted"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
