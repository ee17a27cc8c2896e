"""Secret scans: multipart credential linking.

Strong spans (``assign``, ``access``, ``hex``) count by themselves. Weak spans are parts of a
credential that mean nothing alone: a user name, a short secret, a long key, an endpoint.
An interval join within a scope of ``SCOPE`` code points links the parts of one text, and
a weak part is reported only where a complementary part stands in its scope.

Everything is Spark functions. Positions come from the text around the matches: the pieces
between them and the matches themselves alternate, so running sums of their lengths are
the starts. Null and empty texts have no spans. Repeated rows each get their result; rows
are told apart by ``doc_id`` and the digest of the text, so a null ``doc_id`` is a value
like any other. Further columns of the input are ignored by ``scan``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolot.llm.common import staged, text_or_empty

SCOPE = 200
CHUNK = 1024  # code points that are cut at once
BUCKET = 512


class Kind(NamedTuple):
    """A kind of span: its pattern, its role, and what a match must fulfil.

    ``value`` is the group whose length must reach ``least`` (0: the whole match). A text is
    searched only if it holds one of ``words`` in lower case (none: any text) and matches
    ``hint``, which finds every text that the pattern does.
    """

    name: str
    role: str
    strong: bool
    pattern: str
    hint: str
    words: tuple[str, ...] = ()
    value: int = 0
    least: int = 1


_SET = r"""["']?\x20*[:=]\x20*["']?"""
_END = r"[\x22\x27]?\x20*[:=]"
_SECRETS = "(password|passwd|secret|token|api_?key)"
_USERS = "(user|user_?name|login|client_?id|account)"
_SHORTS = "(pwd|pass|pin|auth|key|credential)"
_SCHEMES = "(https?|ftp|ssh|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp|s3)"
_VALUE = "([A-Za-z0-9+/_.=-]+)"

KINDS = (
    Kind("assign", "secret", True, f"(?i){_SECRETS}{_SET}{_VALUE}", f"(?i){_SECRETS}{_END}",
         ("password", "passwd", "secret", "token", "api"), 2, 6),
    Kind("access", "id", True, "AKIA[A-Z0-9]+", "AKIA", ("akia",), 0, 20),
    Kind("hex", "secret", True, "[0-9a-f]{24,}", "(?<![0-9a-f])[0-9a-f]{24}", (), 0, 24),
    Kind("user", "id", False, rf"(?i)\b{_USERS}{_SET}([A-Za-z0-9_.@+-]+)", rf"(?i)\b{_USERS}{_END}",
         ("user", "login", "client", "account"), 2, 3),
    Kind("short", "secret", False, rf"(?i)\b{_SHORTS}{_SET}{_VALUE}", rf"(?i)\b{_SHORTS}{_END}",
         ("pwd", "pass", "pin", "auth", "key", "credential"), 2, 4),
    Kind("key", "secret", False, "(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])",
         "(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}"),
    Kind("endpoint", "endpoint", False, rf"(?i)\b{_SCHEMES}://[^\x00-\x20<>\x22\x27]+",
         "://", ("://",)),
)
ORDER = {kind.name: i for i, kind in enumerate(KINDS)}


def _matches(kind: Kind) -> Column:
    """Array of (kind, i, gap, size, value) of the matches of a text; mostly empty."""
    text = F.col("t")
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.value))
    rows = F.transform(
        F.arrays_zip(
            found.alias("m"),
            value.alias("v"),
            F.slice(F.split(text, kind.pattern, -1), 1, F.size(found)).alias("g"),
        ),
        lambda x, i: F.struct(
            F.lit(ORDER[kind.name]).alias("kind"),
            i.alias("i"),
            F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("size"),
            F.length(x["v"]).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,value:int>>")
    return F.when(_hinted(kind), rows).otherwise(none)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, kind, start, end) of all spans of all kinds, weak ones included."""
    texts = docs.select("doc_id", text_or_empty().alias("t")).withColumn("low", F.lower("t"))
    rows = (
        texts.where(reduce(or_, map(_hinted, KINDS)))
        .select("doc_id", F.md5("t").alias("digest"), F.concat(*map(_matches, KINDS)).alias("all"))
        .select("doc_id", "digest", F.explode("all").alias("x"))
        .select("doc_id", "digest", "x.*")
        .distinct()  # repeated rows of one document
    )
    upto = (
        Window.partitionBy("doc_id", "digest", "kind")
        .orderBy("i")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    least = F.element_at(
        F.create_map(*[F.lit(x) for k in KINDS for x in (ORDER[k.name], k.least)]), F.col("kind")
    )
    return (
        rows.withColumn("end", end)
        .where(F.col("value") >= least)
        .select("doc_id", "digest", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
    )


def _hinted(kind: Kind) -> Column:
    found = F.col("t").rlike(kind.hint)
    if not kind.words:
        return found
    return reduce(or_, [F.contains(F.col("low"), F.lit(word)) for word in kind.words]) & found


def link(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The strong spans and those weak spans that have a complementary part in their scope.

    A secret needs an identifier or an endpoint, these two need a secret. The parts meet in
    buckets of text positions, so that the join has equal keys of bounded size.
    """
    role = F.element_at(
        F.create_map(*[F.lit(x) for k in KINDS for x in (ORDER[k.name], k.role == "secret")]),
        F.col("kind"),
    )
    strong = F.col("kind").isin([ORDER[k.name] for k in KINDS if k.strong])
    parts = spans.withColumn("secret", role)
    weak = parts.where(~strong).select(
        "*",
        F.explode(
            F.sequence(
                F.floor((F.col("start") - scope) / BUCKET), F.floor((F.col("end") + scope) / BUCKET)
            )
        ).alias("bucket"),
    )
    other = parts.select(
        F.col("doc_id").alias("o_doc"),
        F.col("digest").alias("o_digest"),
        F.col("secret").alias("o_secret"),
        F.col("start").alias("o_start"),
        F.col("end").alias("o_end"),
        F.explode(
            F.sequence(F.floor(F.col("start") / BUCKET), F.floor(F.col("end") / BUCKET))
        ).alias("o_bucket"),
    )
    meets = (
        F.col("doc_id").eqNullSafe(F.col("o_doc"))
        & (F.col("digest") == F.col("o_digest"))
        & (F.col("bucket") == F.col("o_bucket"))
        & (F.col("secret") != F.col("o_secret"))
        & (F.col("o_start") <= F.col("end") + scope)
        & (F.col("start") <= F.col("o_end") + scope)
    )
    linked = weak.join(other, meets, "left_semi").select(spans.columns).distinct()
    return spans.where(strong).unionByName(linked)


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: counts and spans of its secrets.

    ``spans`` is an array of (kind, start, end) by start, then kind; ``end`` is exclusive.
    """
    found = link(staged(candidates(docs), "secret-parts"), scope)
    by_doc = found.groupBy(F.col("doc_id").alias("f_doc"), F.col("digest").alias("f_digest")).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found")
    )
    names = F.create_map(*[F.lit(x) for k in KINDS for x in (ORDER[k.name], k.name)])
    rows = docs.select("doc_id", F.md5(text_or_empty()).alias("digest"))
    spans = F.transform(
        F.coalesce(F.col("found"), F.array()),
        lambda x: F.struct(F.element_at(names, x["kind"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
    )
    return rows.join(
        by_doc,
        F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("digest") == F.col("f_digest")),
        "left",
    ).select("doc_id", spans.alias("spans"))


def spelled(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """Counts of the strong kinds, the digest of their spans, and all spans as text."""
    found = scan(docs)
    strong = [k.name for k in KINDS if k.strong]
    count = lambda name: F.size(
        F.filter("spans", lambda x: x["kind"] == name)
    ).cast("long")
    return found.select(
        "doc_id",
        *[count(name).alias(f"n_{name}") for name in strong],
        F.sha2(spelled(F.filter("spans", lambda x: x["kind"].isin(strong))), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str, scope: int = SCOPE) -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark``; other columns stay as they are.

    Overlapping spans are replaced together. Texts without spans, also null ones, are unchanged.
    """
    found = link(staged(candidates(docs), "secret-parts"), scope)
    before = (
        Window.partitionBy("doc_id", "digest")
        .orderBy("start", "end")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # What stays lies between the largest end so far and the next start; a span that begins earlier overlaps.
    upto = F.coalesce(F.max("end").over(before), F.lit(0)).alias("from")
    gap = F.when(F.col("start") >= F.col("from"), F.struct("from", F.col("start").alias("to")))
    by_doc = (
        found.select("doc_id", "digest", "start", "end", upto)
        .groupBy(F.col("doc_id").alias("f_doc"), F.col("digest").alias("f_digest"))
        .agg(F.sort_array(F.collect_list(gap)).alias("f_gaps"), F.max("end").alias("f_last"))
    )
    rest = F.struct(F.col("f_last").alias("from"), F.length("text").cast("long").alias("to"))
    kept = F.array_join(_pieces(F.col("text"), F.concat("f_gaps", F.array(rest))), mark)
    text = F.when(F.col("f_gaps").isNotNull(), kept).otherwise(F.col("text"))
    keyed = docs.withColumn("f_key", F.md5(text_or_empty()))
    joined = keyed.join(
        by_doc, F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("f_key") == F.col("f_digest")), "left"
    )
    return joined.withColumn("text", text).drop("f_key", "f_doc", "f_digest", "f_gaps", "f_last")


def _pieces(text: Column, ranges: Column) -> Column:
    """The pieces of a text at an array of (from, to), in time linear in the text.

    A position counts code points, so each cut would run through the text from its start. The text becomes
    chunks of ``CHUNK`` code points first, and a piece is put together from those that it touches.
    """

    def within(chunks: Column, i: Column, piece: Column) -> Column:
        start = F.greatest(piece["from"], i * CHUNK)
        size = F.least(piece["to"], (i + 1) * CHUNK) - start
        return F.substring(
            F.get(chunks, i.cast("int")), (start - i * CHUNK + 1).cast("int"), size.cast("int")
        )

    def cut(chunks: Column, piece: Column) -> Column:
        last = F.greatest(piece["from"], piece["to"] - 1)
        touched = F.sequence(F.floor(piece["from"] / CHUNK), F.floor(last / CHUNK))
        return F.array_join(F.transform(touched, lambda i: within(chunks, i, piece)), "")

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    # As an argument of a function the chunks are made once for all pieces.
    return F.transform(
        F.array(chunks), lambda once: F.transform(ranges, lambda piece: cut(once, piece))
    )[0]
