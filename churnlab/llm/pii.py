"""Personal data (operator 7, DataFrame functions only).

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod 97 for bank
accounts, value ranges for addresses and digit counts), and words near a span adjust its score.
The four base kinds stay whatever their score; the method adds bank accounts (IBAN) and social
security numbers where the score reaches ``MIN_SCORE``.

Start and end are code points, end exclusive. They come from the gaps between matches: a text
split by the pattern gives the gaps, and running sums of the lengths give the places. Patterns
use possessive groups (no recursion, no backtracking) and do not start inside a run that was
already tried, so they are linear in the text.

Defined results: a null text counts as empty and has no spans; spans sort by start, then kind as
listed; equal rows give equal rows; an empty table gives an empty result; extra columns are
ignored, or kept by :func:`redact`, where overlapping spans become one mark of the first's kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, text_of

# Kinds in their order, patterns (equal to the contract's, made linear).
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE = 4
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,4})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
#: Score of a confirmed match by kind, and words that raise it within CONTEXT code points.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
WORDS = {
    "email": "e-?mail|contact|write to",
    "ip": "ip|address|host|server",
    "card": "card|visa|master|amex|credit|debit",
    "phone": "phone|call|tel|mobile|fax|cell",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social security|taxpayer",
}
CONTEXT, CONTEXT_BONUS, MIN_SCORE = 40, 0.3, 0.6
_BLOCK = 256


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _mod97(m: Column) -> Column:
    """Remainder of an IBAN: first four characters last, letters as 10 to 35."""
    s = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4))
    step = lambda a, c: F.when(c.rlike("[A-Z]"), (a * 100 + F.ascii(c) - 55) % 97).otherwise((a * 10 + F.ascii(c) - 48) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(12, 19), F.call_function("luhn_check", d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(m, " ", "")).between(15, 34) & (_mod97(m) == 1)
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _running(lengths: Column) -> Column:
    """Running sums of an array, in two levels of blocks so that many matches stay cheap."""
    def in_blocks(v: Column) -> Column:
        n = F.ceil(F.size(v) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))

    def summed(blocks: Column) -> Column:
        return _let(F.transform(blocks, _sum), lambda sums: F.flatten(F.transform(
            blocks, lambda blk, b: _let(_sum(F.slice(sums, 1, b)), lambda before: F.transform(
                blk, lambda x, j: before + _sum(F.slice(blk, 1, j + 1)))))))

    return _let(in_blocks(lengths), summed)


def _spans(kind: str, text: Column, matches: Column) -> Column:
    """Array of (start, kind, end, score) of the confirmed matches of one kind."""
    def placed(gaps: Column) -> Column:
        ends = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        return _let(_running(ends), lambda e: F.filter(F.transform(matches, lambda m, i: F.struct(
            (F.get(e, i) - F.length(m)).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), F.get(e, i).alias("end"),
            _confirmed(kind, m).alias("ok"))), lambda s: s["ok"]))

    def scored(s: Column) -> Column:
        begin = F.greatest(s["start"] - CONTEXT, F.lit(0))
        near = F.concat_ws(" ", F.substring(text, begin + 1, s["start"] - begin), F.substring(text, s["end"] + 1, F.lit(CONTEXT)))
        bonus = F.when(F.lower(near).rlike(rf"(?<![a-z])(?:{WORDS[kind]})"), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                        F.least(F.lit(1.0), F.lit(PRIOR[kind]) + bonus).alias("score"))

    found = F.transform(placed(F.split(text, PATTERNS[kind], -1)), scored)
    if KINDS.index(kind) >= BASE:
        found = F.filter(found, lambda s: s["score"] >= MIN_SCORE)
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,score:double>>")
    return F.when(F.size(matches) > 0, found.cast("array<struct<start:int,kind:int,end:int,score:double>>")).otherwise(nothing)


def _guarded(kind: str, text: Column) -> Column:
    """All matches, looked for only where the text has the sign that every match has."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    sign = {"email": "@", "phone": "+"}.get(kind)
    return F.when(text.contains(sign), found).otherwise(F.array().cast("array<string>")) if sign else found


def find_spans(docs: DataFrame, text_col: str = "text", into: str = "_spans") -> DataFrame:
    """``docs`` with one more column: all spans, sorted, as structs (start, kind number, end, score)."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*kept, text_of(text_col).alias("_t"))
    rows = rows.select(*kept, "_t", *[_guarded(k, F.col("_t")).alias(f"_m_{k}") for k in KINDS])
    rows = rows.select(*kept, *[_spans(k, F.col("_t"), F.col(f"_m_{k}")).alias(f"_s_{k}") for k in KINDS])
    return rows.select(*kept, F.sort_array(F.concat(*[F.col(f"_s_{k}") for k in KINDS])).alias(into))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, their digest, all spans and their scores."""
    rows = find_spans(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body")), "_body")
    spans, count = F.col("_spans"), lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == KINDS.index(k))).cast("bigint")
    return rows.select(
        F.col("_id").alias(id_col), *[count(k).alias(f"n_{k}") for k in KINDS[:BASE]],
        F.sha2(_listed(F.filter(spans, lambda s: s["kind"] < BASE)), 256).alias("base_sha256"), _listed(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by a mark such as ``[EMAIL]``; other columns stay, but
    ``length_col`` (if given) becomes the new length of changed texts."""
    text, marks = F.col("_body"), F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").cast("string").alias("_body"))
    rows = find_spans(rows, "_body")

    def step(a: Column, s: Column) -> Column:
        apart = s["start"] >= a["at"]
        out = F.when(apart, F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(marks, s["kind"]))).otherwise(a["out"])
        return F.struct(out.alias("out"), F.greatest(a["at"], s["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    clean = F.aggregate("_spans", start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    rows = rows.select("_row", F.when(F.size("_spans") > 0, clean).alias("_clean"))
    changed = {text_col: F.col("_clean")} | ({length_col: F.length("_clean")} if length_col in docs.columns else {})
    return rows.select(*[(F.coalesce(changed[c].cast(docs.schema[c].dataType), F.col(f"_row.`{c}`")) if c in changed else F.col(f"_row.`{c}`")).alias(c)
                         for c in docs.columns])


def op7_pii_spans(spark, sf_dir: str) -> DataFrame:
    return span_report(documents(spark, sf_dir))
