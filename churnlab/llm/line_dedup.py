"""Repeated and nearly repeated lines by a segment-partition edit join (operator 9, DataFrame
functions only).

Lines are split at \\n and ordered by (document id, place). A line goes if an equal line came
earlier, or if its text lies within ``EDITS`` edits (code points) of a different line whose first
occurrence is earlier; lines under ``MIN_CHARS`` code points only match exactly.

* Equal lines meet on 128 bits of hash, combined before the shuffle.
* A line of length l is cut into ``EDITS + 1`` segments; two lines within EDITS edits share one. The
  index has a row for each (length, segment number, segment); a line probes, for its own and each
  smaller length, the substrings whose start can be that segment's (the multi-match-aware window
  of the length difference). Of lines with many copies only the first occurrence takes part.
* Keys that only one line has go first. Lines of a key are paired only if the parities of their
  characters (an edit flips two bits at most) and of their pairs of neighbouring characters (four at
  most) allow it, so that many variants of one line don't all meet.
* Pairs are verified by a banded bit-parallel automaton: for each allowed number of edits one word
  has a bit for each diagonal of the band, moved once per character.

Defined results: a null text counts as empty; lines without a word are never removed nor counted;
rows that repeat an id and text are one document for the order of lines and each get the same
result; a null id comes last; an empty table gives an empty result; extra columns are ignored
(kept by :func:`drop_repeated_lines`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, documents, saved, text_of

EDITS, MIN_CHARS = 2, 32
#: Lines with so many copies always take part in the join by their first occurrence only; those with fewer
#: do so where the list of all repeated lines can be broadcast. Results are the same either way.
HOT = 64
SMALL = 1_000_000


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with a word: document (id, text hash), place, line, its hashes, its order."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("d"), F.xxhash64(text).alias("t"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    rows = rows.filter(F.col("line").rlike(f"[^{SPACE}]"))
    order = F.coalesce("d", F.lit(2 ** 63 - 1)).cast("decimal(20,0)") * F.lit(2 ** 32).cast("decimal(10,0)") + F.col("pos")
    return rows.select("d", "t", "pos", "line", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"), order.cast("decimal(38,0)").alias("ord"))


def _segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """(start, length) of each segment, start from 0; the last ones are longer by one if need be."""
    parts = edits + 1
    base, more = F.floor(length / parts).cast("int"), (length % parts)
    out = []
    for i in range(parts):
        longer = F.greatest(more - (parts - i), F.lit(0))  # longer segments before this one
        out.append(((base * i + longer).cast("int"), base + (more >= parts - i).cast("int")))
    return out


def _key(length: Column, number: int, line: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(length.cast("int"), F.lit(number), F.substring(line, start + 1, size))


def index_keys(line: Column, length: Column, edits: int = EDITS) -> Column:
    return F.array(*[_key(length, i, line, s, n) for i, (s, n) in enumerate(_segments(length, edits))])


def probe_keys(line: Column, length: Column, edits: int = EDITS) -> Column:
    """Keys that any line of at most this length within ``edits`` has in the index, but for the line's own index keys."""
    keys = []
    for less in range(edits + 1):
        other = length - less
        for i, (start, size) in enumerate(_segments(other, edits)):
            low, high = max(-i, less - (edits - i)), min(i, less + (edits - i))
            keys += [F.when((start + k >= 0) & (start + k + size <= length), _key(other, i, line, start + k, size)) for k in range(low, high + 1) if less or k]
    return F.array(*keys)  # null where a place is out of the line


def parities(line: Column) -> tuple[Column, Column]:
    """64 bits each: the parity of the characters, and of the pairs of neighbours, that fall on a bit."""
    flip = lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(x, F.lit(64)).cast("int")))
    zero = F.lit(0).cast("bigint")
    pairs = lambda chars: F.zip_with(chars, F.slice(chars, 2, F.size(chars)), lambda x, y: F.xxhash64(x, y))
    return (F.aggregate(F.split(line, ""), zero, lambda a, c: flip(a, F.ascii(c))),
            F.aggregate(_let(F.split(line, ""), pairs), zero, flip))


def within(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether two texts lie within ``edits`` edits; their lengths must not differ by more.

    Word e has bit d where a prefix of ``a`` that is ``d - edits`` longer than the read part of
    ``b`` fits it with e edits at most. A character keeps matching diagonals; an edit comes from the
    word below: the same diagonal (changed), the next (inserted), the one before (left out).
    """
    band = 2 * edits + 1
    all_bits = (1 << band) - 1
    word = lambda e: sum(1 << d for d in range(edits, edits + e + 1))

    def scan(chars: Column) -> Column:
        def step(s: Column, c: Column) -> Column:
            match = sum((F.when(F.get(chars, s["j"] + (d - edits)) == c, 1 << d).otherwise(0) for d in range(band)), F.lit(0))

            def words(m: Column) -> Column:
                new, old = [s["r0"].bitwiseAND(m)], [s[f"r{e}"] for e in range(edits + 1)]
                for e in range(1, edits + 1):
                    moved = old[e].bitwiseAND(m).bitwiseOR(old[e - 1]).bitwiseOR(F.shiftright(old[e - 1], 1)).bitwiseOR(F.shiftleft(new[-1], 1))
                    new.append(moved.bitwiseAND(F.lit(all_bits)))
                return F.struct((s["j"] + 1).alias("j"), *[x.alias(f"r{e}") for e, x in enumerate(new)])

            return _let(match, words)

        start = F.struct(F.lit(0).alias("j"), *[F.lit(word(e)).alias(f"r{e}") for e in range(edits + 1)])
        return F.aggregate(F.split(b, ""), start, step, lambda s: s[f"r{edits}"])

    last = F.length(a) - F.length(b) + edits
    return _let(F.split(a, ""), scan).bitwiseAND(F.call_function("shiftleft", F.lit(1), last.cast("int"))) != 0


def near_links(lines: DataFrame, known: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Pairs (a, b) of line hashes within ``edits`` edits."""
    repeated = lambda n: known.filter(F.col("n") >= n).select(F.col("h").alias("hot"), F.col("first").alias("hot_first"))
    hot = repeated(2) if repeated(2).count() <= SMALL else repeated(HOT)
    if hot.count() <= SMALL:
        hot = F.broadcast(hot)
    own = lines.filter(F.length("line") >= min_chars).join(hot, F.col("h") == F.col("hot"), "left").filter("hot IS NULL OR ord = hot_first")
    own = own.select("h", "line", F.length("line").alias("l"))
    both = F.concat(index_keys(F.col("line"), F.col("l"), edits), probe_keys(F.col("line"), F.col("l"), edits))
    rows = own.select("h", F.posexplode(both).alias("number", "key")).filter("key IS NOT NULL").select("key", "h", (F.col("number") <= edits).alias("indexed"))
    key = Window.partitionBy("key")
    rows = rows.withColumns({"least": F.min("h").over(key), "most": F.max("h").over(key)}).filter("least <> most")
    met = saved(rows.select("key", "h", "indexed").distinct(), "line-keys")
    wanted = met.select("h").distinct()
    if wanted.count() <= SMALL:
        wanted = F.broadcast(wanted)
    texts = own.join(wanted, "h", "left_semi").dropDuplicates(["h"])
    chars, pairs = parities(F.col("line"))
    texts = saved(texts.select("h", "line", "l", chars.alias("chars"), pairs.alias("pairs")), "line-texts")
    signed = met.join(texts.select("h", "l", "chars", "pairs"), "h")
    side = lambda s, which: signed.filter(which).select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("h", "l", "chars", "pairs")])
    flips = lambda c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    close = F.expr(f"l_b BETWEEN l_a AND l_a + {edits} AND h_a <> h_b AND (l_a < l_b OR h_a < h_b)")
    close = close & (flips("chars") <= 2 * edits) & (flips("pairs") <= 4 * edits)
    # a line's own index keys are among those that it probes
    found = side("a", "indexed").join(side("b", "true"), "key").filter(close).select(F.col("h_a").alias("a"), F.col("h_b").alias("b")).distinct()
    text = lambda s: texts.select(F.col("h").alias(s), F.col("line").alias(f"line_{s}"))
    read = found.join(text("a"), "a").join(text("b"), "b")
    return saved(read.filter(within(F.col("line_a"), F.col("line_b"), edits)).select("a", "b"), "line-links")


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents (d, t) with the places of their removed lines: exact, near."""
    lines = lines_of(docs, id_col, text_col)
    hashed = saved(lines.drop("line"), "line-hashes")
    known = saved(hashed.groupBy("h", "g").agg(F.min("ord").alias("first"), F.count("*").alias("n")), "lines")
    links = near_links(lines, known, edits, min_chars)
    first = known.groupBy("h").agg(F.min("first").alias("first"))
    dated = links.join(first.select(F.col("h").alias("a"), F.col("first").alias("fa")), "a").join(first.select(F.col("h").alias("b"), F.col("first").alias("fb")), "b")
    later = dated.select(F.when(F.col("fa") < F.col("fb"), F.col("b")).otherwise(F.col("a")).alias("h")).distinct().withColumn("near", F.lit(True))
    told = known.filter("n > 1").select("h", "g", "first").join(later, "h", "full").select("h", "g", "first", F.coalesce("near", F.lit(False)).alias("near"))
    marks = hashed.join(told.select("h", F.col("g").alias("g2"), "first", "near"), "h")
    exact = F.coalesce((F.col("g") == F.col("g2")) & (F.col("ord") > F.col("first")), F.lit(False))
    marks = marks.select("d", "t", "pos", exact.alias("exact"), "near").filter("exact OR near")
    places = lambda which: F.sort_array(F.collect_set(F.when(which, F.col("pos"))))  # noqa: E731  a document's own lines
    return marks.groupBy("d", "t").agg(places(F.col("exact")).alias("exact"), places(~F.col("exact")).alias("near"))


def _with_kept(docs: DataFrame, id_col: str, text_col: str, edits: int, min_chars: int) -> DataFrame:
    """(_row, _lines, _exact, _near, _kept): every input row with its removed places and what is left."""
    found = line_verdicts(docs, id_col, text_col, edits, min_chars)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").cast("bigint").alias("_d"),
                       F.xxhash64(text_of(text_col)).alias("_t"))
    both = rows.join(found, F.col("_d").eqNullSafe(F.col("d")) & (F.col("_t") == F.col("t")), "left")
    none = F.array().cast("array<int>")
    both = both.select("_row", F.split(text_of(f"_row.{text_col}"), "\n", -1).alias("_lines"),
                       F.coalesce("exact", none).alias("_exact"), F.coalesce("near", none).alias("_near"))
    gone = F.concat("_exact", "_near")
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone)
    kept = F.array_join(F.transform(places, lambda p: F.get("_lines", p)), "\n")
    return both.withColumn("_kept", F.when(F.size(gone) > 0, kept).otherwise(text_of(f"_row.{text_col}")))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the removed lines cut out of the text; a null text stays null."""
    rows = _with_kept(docs, id_col, text_col, edits, min_chars)
    keep = lambda c: F.when(F.col(f"_row.`{c}`").isNotNull(), F.col("_kept")).alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c)
    return rows.select(*[keep(c) for c in docs.columns])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document: id, n_lines (with a word), n_exact, n_near, kept_sha256."""
    rows = _with_kept(docs, id_col, text_col, edits, min_chars)
    n = F.size(F.filter("_lines", lambda x: x.rlike(f"[^{SPACE}]")))
    return rows.select(F.col(f"_row.`{id_col}`").alias(id_col), n.cast("bigint").alias("n_lines"), F.size("_exact").cast("bigint").alias("n_exact"),
                       F.size("_near").cast("bigint").alias("n_near"), F.sha2("_kept", 256).alias("kept_sha256"))


def op9_segment_edit_join(spark, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir))
