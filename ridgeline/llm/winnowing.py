"""Document fingerprints by winnowing, in DataFrame operations only.

Tokens are the words of the lower-cased text.  Words of more than ``MOST_CHARS`` characters, and
all characters from U+0E00 on (scripts that are written without spaces among them), are cut
where their content says so: after every character from U+0E00 on and every one of ``CUT_AFTER``,
and after ``MOST_CHARS`` characters without any of these.  So a passage is cut alike wherever it
stands in a long word, from the first such character on.

Every run of ``k`` tokens has a hash; of every window of consecutive runs the smallest hash is
chosen, the rightmost one on ties, with its token position.  A window has ``w`` runs, in texts of
fewer than ``SHARES * w`` runs one run for every ``SHARES`` of the text (at least one).  Two texts that share a
run of ``w + k - 1`` tokens share a chosen hash: what is chosen in a wide window is also chosen
in the narrower ones.  A text of fewer than ``k`` tokens has one run of all of them, a text
without tokens an empty fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_CHARS = 16
#: Characters after which a long word is cut (in a regular expression's character class).
CUT_AFTER = "aeiou/;,=&."
#: Windows that a short text has at least, for as many runs.
SHARES = 8
_SPACE, _WIDE = r"\x20\x09-\x0D", r"\x{0E00}-\x{10FFFF}"
TOKEN = (rf"(?<![^{_SPACE}])[^{_SPACE}{_WIDE}]{{1,{MOST_CHARS}}}(?![^{_SPACE}])"
         rf"|[^{_SPACE}{_WIDE}{CUT_AFTER}]{{0,{MOST_CHARS - 1}}}[{_WIDE}{CUT_AFTER}]|[^{_SPACE}]{{1,{MOST_CHARS}}}")
#: Fixed: position bits below a packed 32-bit hash.
POSITION_BITS = 31
_POSITION = (1 << POSITION_BITS) - 1


def _columns(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def fingerprint(df: DataFrame, text: str, out: str, k: int = 5, w: int = 16) -> DataFrame:
    """Add ``out``: the chosen runs in text order, each packed as hash * 2**31 + (2**31 - 1 - position).

    The packing makes the smallest value the smallest hash at its rightmost position.  Each
    step is a projection of its own: the steps read their input array more than once, so the
    optimizer does not merge them.
    """
    words, hashes, runs = f"_{out}_words", f"_{out}_hashes", f"_{out}_runs"
    window = f"_{out}_window"
    keep = df.columns
    df = _columns(df, **{words: F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN), F.lit(0))})
    df = _columns(df, **{hashes: F.transform(words, lambda x: F.xxhash64(x))})
    run = ", ".join(f"get({hashes}, i + {j})" for j in range(k))
    df = _columns(df, **{runs: F.expr(
        f"CASE WHEN size({hashes}) = 0 THEN CAST(array() AS ARRAY<BIGINT>) "
        f"ELSE transform(sequence(0, greatest(size({hashes}) - {k}, 0)), i -> "
        f"(xxhash64({run}) & 4294967295L) * {1 << POSITION_BITS}L + ({_POSITION}L - i)) END")})
    df = _columns(df, **{window: F.expr(f"least({w}, greatest(1, cast(ceil(size({runs}) / {SHARES}) as int)))")})
    df = _columns(df, **{out: F.expr(
        f"CASE WHEN size({runs}) = 0 THEN {runs} ELSE array_distinct("
        f"transform(sequence(1, greatest(size({runs}) - {window} + 1, 1)), i -> array_min(slice({runs}, i, {window})))) END")})
    return df.select(*keep, out)


def as_string(packed: Column) -> Column:
    """``hash:position`` pairs, hashes as 8 hex digits, in text order."""
    return F.array_join(F.transform(packed, lambda x: F.concat(
        F.lower(F.lpad(F.hex(F.shiftrightunsigned(x, POSITION_BITS)), 8, "0")), F.lit(":"),
        (F.lit(_POSITION) - x.bitwiseAND(F.lit(_POSITION))).cast("string"))), " ")


def hash_set(packed: Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda x: F.shiftrightunsigned(x, POSITION_BITS)))


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two hash sets; two empty ones are alike, an empty one is like no other."""
    both = F.size(F.array_intersect(F.col(a), F.col(b)))
    either = F.size(F.col(a)) + F.size(F.col(b)) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _range_of(edges: list[int], doc_id: Column) -> Column:
    """How many edges are at most ``doc_id`` (binary search in a constant array); null is 0."""
    if not edges:
        return F.lit(0)
    steps = [1 << b for b in reversed(range(len(edges).bit_length()))]
    array = "array(" + ",".join(f"{e}L" for e in edges) + ")"
    search = (f"aggregate(array({','.join(map(str, steps))}), 0, (at, step) -> "
              f"CASE WHEN at + step <= {len(edges)} AND get({array}, at + step - 1) <= _range_id THEN at + step ELSE at END)")
    del doc_id
    return F.coalesce(F.expr(search), F.lit(0))


def with_next(docs: DataFrame, range_docs: int = 1024, most_ranges: int = 16_384) -> DataFrame:
    """``doc_id, text`` and the ``_window`` to look ahead in: rows in ascending ``doc_id``, the first after the last.

    Rows are dealt into ranges of ids at approximate quantiles; each range ends with a copy
    of the first row of the next one (``_copy``), so that looking one row ahead never
    leaves a range.  The texts are shuffled once.  Null ids come first; rows of one id are
    ordered by text.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = min(most_ranges, max(1, -(-docs.count() // range_docs)))
    edges: list[int] = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        edges = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 8 * ranges)).first()[0] or []))
    ranged = rows.withColumn("_range_id", F.col("doc_id")).withColumn("_range", _range_of(edges, F.col("doc_id"))).drop("_range_id")
    # one row per range: bounded by most_ranges
    starts = ranged.groupBy("_range").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("_low")).select(
        "_range", F.col("_low.doc_id").alias("_low"))
    order = Window.orderBy("_range")
    starts = starts.withColumn("_to", F.coalesce(F.lag("_range").over(order), F.max("_range").over(Window.partitionBy())))
    first = (ranged.join(F.broadcast(starts.withColumnRenamed("_range", "_of")),
                         (ranged["_range"] == F.col("_of")) & ranged["doc_id"].eqNullSafe(F.col("_low")))
             .groupBy(F.col("_to").alias("_range")).agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text")))
    return ranged.withColumn("_copy", F.lit(0)).unionByName(first.withColumn("_copy", F.lit(1)))


def fingerprint_documents(docs: DataFrame, k: int = 5, w: int = 16) -> DataFrame:
    """Fingerprints of every whole text, of its edited text and their likeness.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as
    many (or all) of the next document's, in ascending ``doc_id``; after the last comes the
    first.  Null text is empty text; null ids come first; repeated rows are rows of their own,
    next to each other; an empty table gives no rows; other columns are not read.
    """
    ahead = Window.partitionBy("_range").orderBy("_copy", F.col("doc_id").asc_nulls_first(), "text")
    rows = with_next(docs).withColumn("_next", F.lead("text").over(ahead)).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("_edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.coalesce(F.col("_next"), F.lit("")), F.lit(1), half)))
    rows = fingerprint(rows, "text", "_print", k, w)
    rows = rows.withColumn("_set", hash_set(F.col("_print"))).withColumn("_next_set", F.lead("_set").over(ahead))
    rows = rows.where("_copy = 0").select("doc_id", "n_chars", "_edited", "_print", "_set", "_next_set")
    rows = fingerprint(rows, "_edited", "_edited_print", k, w)
    rows = rows.withColumn("_edited_set", hash_set(F.col("_edited_print")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        as_string(F.col("_print")).alias("fingerprint"), as_string(F.col("_edited_print")).alias("edited_fingerprint"),
        likeness("_set", "_edited_set").alias("near_edited"), likeness("_set", "_next_set").alias("near_next"))
