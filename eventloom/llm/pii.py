"""Personal data, with DataFrame functions only: expressions propose spans, checksums confirm, context words adjust.

A kind's matches come from regexp_extract_all, what lies between them from split with the same expression; the lengths
of both, summed up by doubling steps, give the places (code points, and bytes for cutting). The expressions are written
without ambiguous repetition, so they take linear time on any text and give what the plain forms in their comments give,
leftmost and without overlap. Base kinds (email, ip, card, phone) always stay once valid; further kinds stay if their
score, raised by context words within 40 characters (and AROUND matches of the kind), reaches 0.6. Null and empty texts
have no spans; repeated rows each get theirs. Nothing is copied for each span, so texts with very many take no longer
than n log n steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: A text without a digit has no such match.
DIGIT = "digit"
#: Kind, expression, what a text must contain for it (one of some strings, or a digit), score, score beside a context word, words.
KINDS = [
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ : starts where a run starts or the last match ended
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", ("@",), 0.9, 1.0, "mail|contact|write|kontakt|correo"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    ("ip", r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}", DIGIT, 0.7, 0.9, "ip|host|server|address|login"),
    # [0-9]([\x20-]?[0-9])+, 14 to 19 digits: whole runs of that many digits
    ("card", r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", DIGIT, 0.8, 1.0, "card|visa|pay|karte|carte|tarjeta"),
    # \+[0-9][\x20().0-9-]+[0-9], 10 to 15 digits
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", ("+",), 0.8, 1.0, "phone|call|tel|mobile|fax"),
    ("iban", r"[A-Z](?<![A-Za-z0-9].)[A-Z][0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", DIGIT, 0.8, 1.0, "iban|bank|account|konto|compte|cuenta"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", DIGIT, 0.4, 0.9, "ssn|social|security"),
    ("local_phone", r"[(0-9](?<![0-9+(-].)(?:(?<=\()[0-9])?[0-9]{2}\)?[\x20-][0-9]{3}[\x20-][0-9]{4}(?![0-9-])", DIGIT, 0.4, 0.8, "phone|call|tel|mobile|fax"),
    ("key", r"(?:AKIA(?<![A-Za-z0-9_]AKIA)[0-9A-Z]{16}|gh[pousr]_(?<![A-Za-z0-9_].{4})[A-Za-z0-9]{36}|sk_live_(?<![A-Za-z0-9_].{8})[A-Za-z0-9]{24,64})(?![A-Za-z0-9_])", ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk_live_"), 0.9, 1.0, "key|token|secret"),
]
BASE = ("email", "ip", "card", "phone")
KEEP, NEAR, AROUND = 0.6, 40, 4


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a string pass Luhn's check; other characters are skipped."""
    each = F.filter(F.split(F.reverse(_digits(value)), ""), lambda c: c != "")
    total = F.aggregate(
        F.transform(each, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*(F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1))),
        F.lit(0), lambda a, x: a + x,
    )
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an IBAN's number, letters as 10 to 35 and its first four characters last, leaves 1 modulo 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    each = F.filter(F.split(moved, ""), lambda c: c != "")
    return F.aggregate(each, F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)) == 1


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return v.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return luhn(v)
    if kind == "phone":
        return F.length(_digits(v)).between(10, 15)
    if kind == "iban":
        return mod97(v)
    return F.lit(True)


def _running(values: Column, join) -> Column:
    """Running totals of an array: after step k each element has joined the 2**k elements up to it."""

    def step(acc: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(acc, lambda x, i: F.when(i >= back, join(x, F.get(acc, i - back))).otherwise(x))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values).cast("double"))).cast("int") - 1)
    return F.when(F.size(values) <= 1, values).otherwise(F.aggregate(steps, values, step))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string,score:double,from:int,to:int>>"


def _spans_of(gaps: Column, found: Column, order: int) -> Column:
    """The valid spans of a kind from the texts between the matches and the matches: places in code points, from and to in bytes."""
    kind, _, _, alone, beside, words = KINDS[order]

    def near(i: Column) -> Column:
        before = [x for k in range(AROUND, 0, -1) for x in (F.right(F.get(gaps, i - k), F.lit(NEAR)), F.get(found, i - k))]
        after = [x for k in range(1, AROUND + 1) for x in (F.left(F.get(gaps, i + k), F.lit(NEAR)), F.get(found, i + k))]
        none = F.lit("")
        left = F.right(F.concat(*(F.coalesce(x, none) for x in before), F.right(F.get(gaps, i), F.lit(NEAR))), F.lit(NEAR))
        right = F.left(F.concat(*(F.coalesce(x, none) for x in after)), F.lit(NEAR))
        return F.lower(F.concat(left, F.get(found, i), right))

    def made(ends: Column, to: Column) -> Column:
        def span(hit: Column, i: Column) -> Column:
            end, last = F.get(ends, i), F.get(to, i)
            score = F.when(near(i).rlike(rf"(?<![a-z])(?:{words})"), F.lit(beside)).otherwise(F.lit(alone))
            return F.struct(
                (end - F.length(hit)).alias("start"), F.lit(order).alias("kind_no"), end.alias("end"), F.lit(kind).alias("kind"), hit.alias("value"),
                F.when(_valid(kind, hit), score).alias("score"), (last - F.octet_length(hit)).alias("from"), last.alias("to"),
            )

        return F.transform(found, span)

    sizes = lambda length: F.transform(found, lambda hit, i: length(F.get(gaps, i)) + length(hit))
    add = lambda x, y: x + y
    spans = _let(F.struct(_running(sizes(F.length), add).alias("ends"), _running(sizes(F.octet_length), add).alias("to")), lambda p: made(p["ends"], p["to"]))
    least = 0.0 if kind in BASE else KEEP
    return F.when(F.size(found) > 0, F.filter(spans, lambda x: x["score"] >= least)).otherwise(F.array()).cast(SPAN)


def with_spans(docs: DataFrame) -> DataFrame:
    """All columns and `pii`: array of (start, kind_no, end, kind, value, score, from, to), by start, then kind as in KINDS."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found, gaps = {}, {}
    for kind, expr, has, *_ in KINDS:
        may = F.col("_digit") if has == DIGIT else reduce(lambda a, b: a | b, (F.contains(text, F.lit(x)) for x in has))
        found[f"_hit_{kind}"] = F.when(may, F.regexp_extract_all(text, F.lit(expr), F.lit(0))).otherwise(F.array().cast("array<string>"))
        gaps[f"_gap_{kind}"] = F.when(F.size(f"_hit_{kind}") > 0, F.split(text, expr, -1))
    out = docs.withColumn("_digit", text.rlike("[0-9]")).withColumns(found).withColumns(gaps)
    every = F.concat(*(_spans_of(F.col(f"_gap_{k[0]}"), F.col(f"_hit_{k[0]}"), i) for i, k in enumerate(KINDS)))
    return out.withColumn("pii", F.sort_array(every)).drop("_digit", *found, *gaps)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans, max_score."""
    out = with_spans(common.id_text(docs))
    base = F.filter("pii", lambda x: x["kind_no"] < len(BASE))
    count = [F.size(F.filter("pii", lambda x: x["kind_no"] == i)).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return out.select("doc_id", *count, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"), F.size("pii").cast("long").alias("n_spans"), F.array_max(F.transform("pii", lambda x: x["score"])).alias("max_score"))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; a span that starts before one that began earlier has ended is dropped."""

    def cut(raw: Column) -> Column:
        reach = _running(F.transform("pii", lambda x: x["end"]), lambda x, y: F.greatest(x, y))

        def kept_of(reach: Column) -> Column:
            return F.filter("pii", lambda x, i: (i == 0) | (x["start"] >= F.get(reach, i - 1)))

        def joined(kept: Column) -> Column:
            bytes_of = lambda a, b: F.substr(raw, a + 1, b - a).cast("string")
            before = lambda i: F.coalesce(F.get(kept, i - 1)["to"], F.lit(0))
            pieces = F.transform(kept, lambda x, i: F.concat(bytes_of(before(i), x["from"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
            return F.concat(F.array_join(pieces, ""), bytes_of(F.get(kept, F.size(kept) - 1)["to"], F.octet_length(raw)))

        return _let(_let(reach, kept_of), joined)

    new = _let(F.col("text").cast("binary"), cut)
    return with_spans(docs).withColumn("text", F.when(F.size("pii") > 0, new).otherwise(F.col("text"))).drop("pii")
