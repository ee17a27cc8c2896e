"""Document fingerprints: winnowing.

A text is the sequence of its words (runs of characters other than white space in lower case; a run
over ``PIECE`` characters counts as several). Each ``GRAM`` words in a row have a cyclic rolling hash
``rotl(h1, 4) ^ rotl(h2, 3) ^ ... ^ h5``. In every ``WINDOW`` hashes in a row the smallest is
chosen, of equal ones the rightmost, and kept with its position. So any run of
``GRAM + WINDOW - 1`` words that two texts share gives them a common fingerprint entry.

Everything is Spark functions on arrays of one row. Rolling hashes and window minima double their
span step by step, so five and eight words take three steps each. Texts under ``GRAM`` words have one
hash of all their words, texts without words (also null and empty ones) an empty fingerprint;
two empty fingerprints have likeness 1, an empty and another one 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolot.llm.common import text_or_empty

GRAM = 5
WINDOW = 8
PIECE = 32
WORDS = rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"
LAST = 2**31 - 1
MAX_BUCKETS = 65536
BUCKET_ROWS = 64


def _rotl(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits))


def _joined(a: Column | str, b: Column | str, shift: int, fn) -> Column:
    """``fn`` of each element of ``a`` and the element of ``b`` that stands ``shift`` later."""
    n = F.greatest(F.lit(0), F.size(b) - shift)
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(shift + 1), n), fn)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with an array column of chosen hashes, packed as ``hash << 32 | LAST - position``.

    The complement of the position makes the rightmost of equal hashes the smallest value.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_g", _joined("_h", "_h", 1, lambda a, b: _rotl(a, 1).bitwiseXOR(b)))
    df = df.withColumn("_g", _joined("_g", "_g", 2, lambda a, b: _rotl(a, 2).bitwiseXOR(b)))
    df = df.withColumn("_g", _joined("_g", "_h", 4, lambda a, b: _rotl(a, 1).bitwiseXOR(b)))
    df = df.withColumn(
        "_g",
        F.when(F.size("_h") >= GRAM, F.col("_g"))
        .when(F.size("_h") > 0, F.array(F.xxhash64("_h")))
        .otherwise(F.array().cast("array<bigint>")),
    )
    df = df.withColumn(
        "_g",
        F.transform(
            "_g",
            lambda g, i: F.shiftleft(F.shiftrightunsigned(g, 33), 32).bitwiseOR((LAST - i).cast("long")),
        ),
    )
    df = df.withColumn("_m", _joined("_g", "_g", 1, _smaller))
    df = df.withColumn("_m", _joined("_m", "_m", 2, _smaller))
    df = df.withColumn("_m", _joined("_m", "_m", 4, _smaller))
    chosen = (
        F.when(F.size("_g") >= WINDOW, F.array_distinct("_m"))
        .when(F.size("_g") > 0, F.array(F.array_min("_g")))
        .otherwise(F.col("_g"))
    )
    return df.withColumn(out, chosen).drop("_h", "_g", "_m")


def hashes(chosen: Column | str) -> Column:
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, 32)))


def spelled(chosen: Column | str) -> Column:
    """A fingerprint as text: ``hash:position`` in the order of the text, hash in hexadecimal."""
    return F.array_join(
        F.transform(
            chosen,
            lambda x: F.concat_ws(
                ":", F.lower(F.hex(F.shiftright(x, 32))), LAST - x.bitwiseAND(F.lit(LAST).cast("long"))
            ),
        ),
        ",",
    )


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two columns of ``hashes``."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def with_next(
    docs: DataFrame, columns: list[str], prepare: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``prepare(docs)`` with ``next``: ``columns`` of the next row by ``doc_id``, then text.

    Null ids come first; after the last row comes the first. Rows go to buckets of neighbouring ids
    and one shuffle moves them. The first row of the next bucket also closes a bucket; there are
    at most ``MAX_BUCKETS`` such rows, whatever the input.
    """
    low, high, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    low, high = low or 0, high or 0
    buckets = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    width = -(-(high - low + 1) // buckets)
    in_bucket = F.coalesce(F.expr(f"doc_id div {width}L"), F.lit(-(2**62)))
    rows = docs.withColumn("bucket", in_bucket)
    firsts = rows.groupBy("bucket").agg(F.min("doc_id").alias("first_id"))
    by_id = Window.partitionBy(F.lit(1)).orderBy("bucket")
    whole = by_id.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    closing = firsts.select(
        F.coalesce(F.lag("bucket").over(by_id), F.last("bucket").over(whole)).alias("to"),
        F.col("bucket").alias("of"),
        "first_id",
    )
    closing = (
        rows.join(
            F.broadcast(closing),
            (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
        )
        .groupBy(F.col("to").alias("bucket"))
        .agg(F.min("text").alias("text"))
        .select("bucket", F.lit(True).alias("closing"), "text")
    )
    order = Window.partitionBy("bucket").orderBy("closing", F.asc_nulls_first("doc_id"), "text")
    rows = rows.withColumn("closing", F.lit(False))
    return (
        prepare(rows.unionByName(closing, allowMissingColumns=True))
        .withColumn("next", F.lead(F.struct(*columns)).over(order))
        .where(~F.col("closing"))
        .drop("bucket", "closing")
    )


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness.

    The edited text ends in the start of the next document instead of the text's last half.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    rows = with_next(
        texts, ["text", "chosen"], lambda df: with_fingerprint(df, "text", "chosen")
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited",
        F.concat(
            F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
            F.substring("next.text", F.lit(1), half),
        ),
    )
    rows = with_fingerprint(rows, "edited", "edited_chosen")
    rows = rows.select(
        "doc_id", "n_chars", "edited", "chosen", "edited_chosen",
        hashes("chosen").alias("own"), hashes("edited_chosen").alias("other"), hashes("next.chosen").alias("after"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spelled("chosen").alias("fingerprint"),
        spelled("edited_chosen").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"),
        likeness("own", "after").alias("near_next"),
    )
