"""Suffix-array dedup: bytes covered by strings of ``LENGTH`` bytes that start in an earlier document.

The suffix order comes from the difference-cover algorithm: positions 1 and 2 modulo 3 are sampled, their
triples sorted and named, names of triples of names sorted again until they reach over ``LENGTH``
bytes, the remaining suffixes merged in by their first bytes and the rank behind them, and then prefixes
of neighbours compared.

Sorting every suffix of the corpus moves more than ten bytes for each byte of text, so text that can't
repeat is set aside first, exactly: among the ``GRAM``-byte strings in a string of ``LENGTH`` bytes the one with
the smallest hash (rightmost of equal ones) is its anchor. Equal strings have equal anchors at equal
places. The bytes of the strings that one place anchors are its piece, known by a 64-bit hash beside the anchor's. Of
equal pieces all but those of the smallest document are covered as a whole, and no bytes are moved for them. The
others go into the suffix sort if their anchor still occurs in two documents. Both are decided first within a batch of
texts, then in groups by the anchor's hash, whose number grows with the text; of an anchor with many different pieces
in a batch only a summary comes there. Pieces are dealt by anchor. A string has at least ``HALF`` bytes before or behind
its anchor, so only pieces that are equal that far on one side are sorted. Anchors with more than
``HOT`` occurrences are dealt over several blocks; what a block finds first is compared between blocks by
digests of the strings, so no task gets all of them.

Null and empty texts have no bytes. Rows that repeat a ``doc_id`` don't count as earlier for each other;
a null ``doc_id`` counts as later than all others. A row is told by its id and a 64-bit hash of its text, its
tag; rows equal in both have equal results. Long texts are read in segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolot.llm.common import staged, text_or_empty

LENGTH = 50
GRAM = 18
SPAN = LENGTH - GRAM + 1
HALF = (LENGTH - GRAM) // 2
SEGMENT = 1 << 19
FLUSH = 1_000_000
PART_BITS = 8
HASH_BITS = 48
GROUP_BYTES = 24_000_000
FEW = 100
HOT = 8_000
BLOCK_PIECES = 8_000
LAST_ID = 2**63 - 1
U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Hasher:
    """Hashes of substrings from running sums of byte values times powers of an odd base."""

    def __init__(self) -> None:
        self.values = _mix(np.arange(1, 257, dtype=np.uint64) * U(BASE))
        self.powers = self._powers(BASE)
        self.backward = self._powers(INVERSE)

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        out = np.full(SEGMENT + LENGTH + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
        return _mix((sums[start + size] - sums[start]) * self.backward[start])


def segments(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a text that hold each string of ``LENGTH`` bytes once."""
    for at in range(0, max(0, len(data) - LENGTH + 1), SEGMENT):
        yield at, data[at : at + SEGMENT + LENGTH - 1]


def anchors(hasher: Hasher, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first, last): each anchor and the starts of the strings that it anchors."""
    sums = hasher.sums(data)
    h = hasher.at(sums, np.arange(len(data) - GRAM + 1), GRAM)
    # 44 bits of the hash, then the complement of the place, so that the rightmost is smallest
    key = (h & ~U((1 << 20) - 1)) | (U((1 << 20) - 1) - np.arange(len(h), dtype=np.uint64))
    low, size = key, 1
    while size < SPAN:
        step = min(size, SPAN - size)
        low = np.minimum(low[: len(low) - step], low[step:])
        size += step
    first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    last = np.append(first[1:], len(low)) - 1
    place = (U((1 << 20) - 1) - (low[first] & U((1 << 20) - 1))).astype(np.int64)
    return h[place], place, first, last


def anchored(hasher: Hasher, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, piece, first, last): each anchor, the hash of all bytes of its strings, and their starts."""
    h, _, first, last = anchors(hasher, data)
    return h, hasher.at(hasher.sums(data), first, last - first + LENGTH), first, last


def held_before(h: np.ndarray, piece: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a smaller document holds an equal piece of the same anchor."""
    order = np.argsort(h, kind="stable")
    start = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1])[: len(h)])
    count = np.diff(np.append(start, len(h)))
    k = order[np.repeat(count > 1, count)]
    k = k[np.lexsort((doc[k], piece[k], h[k]))]
    start = np.flatnonzero(np.append(True, (h[k][1:] != h[k][:-1]) | (piece[k][1:] != piece[k][:-1]))[: len(k)])
    out = np.zeros(len(h), bool)
    out[k] = doc[k] > np.repeat(doc[k][start], np.diff(np.append(start, len(k))))
    return out


def joined_runs(doc: np.ndarray, tag: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs with those joined that follow one another; equal ones come once."""
    k = np.lexsort((low, tag, doc))
    doc, tag, low, high = doc[k], tag[k], low[k], high[k]
    new = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (low[1:] > high[:-1] + 1)
    start = np.flatnonzero(np.append(True, new))
    return doc[start], tag[start], low[start], high[np.append(start[1:], len(k)) - 1]


def _pack(x: np.ndarray) -> bytes:
    """Integers as compressed differences."""
    return zstandard.compress(np.diff(x.astype(np.int64), prepend=0).tobytes(), 1)


def _unpack(x: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(x), np.int64))


def short_hash(h: np.ndarray) -> np.ndarray:
    """``HASH_BITS`` bits, spread again, since anchors have the smallest hashes. Different anchors that
    share them only cause more places to be looked at."""
    return _mix(h) >> U(64 - HASH_BITS)


def _low_bytes(x: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _from_low_bytes(x: bytes, size: int) -> np.ndarray:
    wide = np.zeros((len(x) // size, 8), np.uint8)
    wide[:, :size] = np.frombuffer(x, np.uint8).reshape(-1, size)
    return wide.view(np.uint64).ravel()


def _as_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def group_bits(docs: DataFrame) -> int:
    """Bits of the hash that number the groups of anchors: about one group for ``GROUP_BYTES`` of text."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(PART_BITS, (total // GROUP_BYTES).bit_length())


def packed_anchors(docs: DataFrame, bits: int) -> DataFrame:
    """Anchors of batches of texts as packed columns, dealt by a hash's first bits, part.

    Pieces that a smaller document of the batch holds too travel apart, under a negative part, as runs of covered
    starts. Of an anchor with more than ``FEW`` other places in the batch only the smallest and largest document and the
    count go to its part; these places travel apart too.
    """

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, held, n = Hasher(), [], 0
        for batch in batches:
            for doc_id, tag, text in zip(batch["doc_id"], batch["tag"], batch["text"], strict=True):
                data = _as_bytes(text)
                for at, part in segments(data):
                    h, piece, first, last = anchored(hasher, part)
                    held.append((short_hash(h), piece, np.full(len(h), doc_id), np.full(len(h), tag), first + at, last + at))
                    n += len(h)
                if n >= FLUSH:
                    yield packed(held)
                    held, n = [], 0
        if held:
            yield packed(held)

    def distinct(k: np.ndarray, *columns: np.ndarray) -> np.ndarray:
        """Equal rows have equal places; each place travels once a batch."""
        new = np.zeros(max(0, len(k) - 1), bool)
        for x in columns:
            new |= x[k[1:]] != x[k[:-1]]
        return k[np.append(np.ones(min(1, len(k)), bool), new)]

    def packed(held: list) -> pd.DataFrame:
        columns = [np.concatenate(x) for x in zip(*held, strict=True)]
        held.clear()
        rows = []
        gone = held_before(*columns[:3])
        apart = -1 - int(_mix(columns[0].sum(dtype=np.uint64)) >> U(2))
        if gone.any():
            doc, tag, low, high = joined_runs(*(x[gone] for x in columns[2:]))
            rows.append((apart, len(doc), None, None, *map(_pack, (doc, tag, low, high)), None, None, None, None))
        h, piece, doc, tag, low, high = (x[~gone] for x in columns)
        del columns
        order = np.argsort(h, kind="stable")
        start = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
        count = np.diff(np.append(start, len(h)))
        known = count > FEW
        first, total = h[order][start][known], count[known]
        least, most = np.minimum.reduceat(doc[order], start)[known], np.maximum.reduceat(doc[order], start)[known]
        is_known = np.zeros(len(h), bool)
        is_known[order] = np.repeat(known, count)
        del order, start, count
        if len(first):
            k = np.flatnonzero(is_known)
            k = distinct(k[np.lexsort((low[k], tag[k], doc[k]))], doc, tag, low)
            rows.append((apart, len(k), _low_bytes(h[k], 6), None, *(_pack(x[k]) for x in (doc, tag, low, high)), None, None, None, None))
        shift = U(HASH_BITS - bits)
        k = np.flatnonzero(~is_known)
        k = distinct(k[np.lexsort((low[k], tag[k], doc[k], h[k] >> shift))], doc, tag, low)
        part, first_part = (h[k] >> shift).astype(np.int64), (first >> shift).astype(np.int64)
        for p in np.union1d(part, first_part):
            own = k[slice(*np.searchsorted(part, [p, p + 1]))]
            b = slice(*np.searchsorted(first_part, [p, p + 1]))
            rows.append(
                (int(p), len(own), _low_bytes(h[own], 5), piece[own].tobytes(), _pack(doc[own]), _pack(tag[own]))
                + (_pack(low[own]), _pack(high[own] - low[own]))
                + tuple(_pack(x[b]) for x in (first, least, most, total))
            )
        return pd.DataFrame(rows, columns=names)

    names = ["part", "n", "h", "piece", "doc", "tag", "low", "high", "known", "least", "most", "count"]
    binary = ", ".join(f"{name} binary" for name in names[2:])
    return docs.mapInPandas(emit, f"part long, n int, {binary}")


def repeated_places(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, low, high, h, copies): the starts that a place anchors, from low to high.

    With h -1 they are covered; with copies 0 they must be compared with others of the anchor. Some of these may be of
    anchors that one document holds. Each anchor of more than ``HOT`` places to compare comes once with low -1.
    """
    bits = group_bits(docs)

    def meet(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key[0] < 0:
            for batch in parts:
                for row in batch.itertuples(index=False):
                    doc, tag, low, high = map(_unpack, (row.doc, row.tag, row.low, row.high))
                    h = np.full(len(doc), -1) if row.h is None else _from_low_bytes(row.h, 6).view(np.int64)
                    yield from shown(doc, tag, low, high, h)
            return
        single, known = [], []
        for batch in parts:
            for row in batch.itertuples(index=False):
                own = map(_unpack, (row.doc, row.tag, row.low, row.high))
                single.append((_from_low_bytes(row.h, 5), np.frombuffer(row.piece, np.uint64), *own))
                known.append(tuple(map(_unpack, (row.known, row.least, row.most, row.count))))
        h, piece, doc, tag, low, high = (np.concatenate(x) for x in zip(*single, strict=True))
        single.clear()
        high += low
        gone = held_before(h, piece, doc)
        yield from shown(doc[gone], tag[gone], low[gone], high[gone], np.full(int(gone.sum()), -1))
        h, doc, tag, low, high = (x[~gone] for x in (h, doc, tag, low, high))
        del piece, gone
        top = U(key[0] >> (bits - PART_BITS) << (HASH_BITS - PART_BITS))
        h = (h | top).view(np.int64)
        first, least, most, count = (np.concatenate(x) for x in zip(*known, strict=True))
        every, least, most = np.append(h, first), np.append(doc, least), np.append(doc, most)
        if not len(every):
            return
        unique, group = np.unique(every, return_inverse=True)
        order = np.argsort(group, kind="stable")
        start = np.searchsorted(group[order], np.arange(len(unique)))
        repeated = np.minimum.reduceat(least[order], start) < np.maximum.reduceat(most[order], start)
        total = np.add.reduceat(np.append(np.ones(len(h), np.int64), count)[order], start)
        k = np.flatnonzero(repeated[group[: len(h)]])
        yield from shown(doc[k], tag[k], low[k], high[k], h[k])
        hot = np.flatnonzero(total > HOT)
        none = np.zeros(len(hot), np.int64)
        yield pd.DataFrame({"doc_id": none, "tag": none, "low": none - 1, "high": none, "h": unique[hot], "copies": total[hot]})

    def shown(*columns: np.ndarray) -> Iterator[pd.DataFrame]:
        for at in range(0, len(columns[0]), 100_000):
            rows = dict(zip(("doc_id", "tag", "low", "high", "h"), (x[at : at + 100_000] for x in columns), strict=True))
            yield pd.DataFrame(rows | {"copies": 0})

    blobs = packed_anchors(docs, bits)
    return blobs.groupBy("part").applyInPandas(meet, "doc_id long, tag long, low long, high long, h long, copies long")


def suffix_order(data: np.ndarray, n: int) -> np.ndarray:
    """The first n positions by their first ``LENGTH`` bytes or more: difference-cover algorithm.

    ``data`` goes on for at least ``3 * LENGTH`` bytes after them. Positions 1 and 2 modulo 3 are sampled.
    """
    d = data.astype(np.int64)
    place = np.arange(len(d) - 2)
    place = place[place % 3 != 0]
    name = np.zeros(len(d), np.int64)
    name[place] = np.unique((d[place] << 16) | (d[place + 1] << 8) | d[place + 2], return_inverse=True)[1] + 1
    reach = 3
    while reach < LENGTH:  # names of three names that follow one another
        place = place[place < len(d) - 3 * reach]
        a, b, c = name[place], name[place + reach], name[place + 2 * reach]
        order = np.lexsort((c, b, a))
        a, b, c = a[order], b[order], c[order]
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
        name = np.zeros(len(d), np.int64)
        name[place[order]] = np.append(0, np.cumsum(new)) + 1
        reach *= 3
    zero, one, two = (np.arange(k, n, 3) for k in range(3))
    width = int(name.max()) + 2
    first = d[zero] * width + name[zero + 1]
    sampled = np.sort(np.concatenate([name[one], name[two]]))
    # How many sampled positions come before: by rank, or by the bytes up to the next common sample.
    rank, later, tie = np.empty(n, np.int64), np.ones(n, np.int8), np.zeros(n, np.int64)
    rank[one], rank[two] = (np.searchsorted(sampled, name[k]) for k in (one, two))
    rank[zero] = np.searchsorted(np.sort(d[one] * width + name[one + 1]), first)
    rank[zero] += np.searchsorted(
        np.sort((d[two] * 256 + d[two + 1]) * width + name[two + 2]),
        (d[zero] * 256 + d[zero + 1]) * width + name[zero + 2],
    )
    later[zero], tie[zero] = 0, first
    return np.lexsort((tie, later, rank))


def equal_strings(data: np.ndarray, n: int, starts: np.ndarray) -> np.ndarray:
    """Group number of the string at each start: prefixes of neighbours in suffix order are compared."""
    wanted = np.full(n, -1)
    wanted[starts] = np.arange(len(starts))
    order = wanted[suffix_order(data, n)]
    order = order[order >= 0]
    rows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    differs = np.zeros(len(order), bool)
    for at in range(1, len(order), 100_000):
        a, b = starts[order[at - 1 : at + 99_999]], starts[order[at : at + 100_000]]
        a = a[: len(b)]
        differs[at : at + len(b)] = (rows[a] != rows[b]).any(axis=1)
    group = np.empty(len(starts), np.int64)
    group[order] = np.cumsum(differs)
    return group


def alike(pieces: np.ndarray) -> np.ndarray:
    """Whether a piece may share a string with another one: equal on one side of the anchor for ``HALF`` bytes."""
    hasher, at_once = Hasher(), SEGMENT // (SPAN + LENGTH)
    before, behind = np.zeros((2, len(pieces)), np.uint64)
    has_before, has_behind = np.zeros((2, len(pieces)), bool)
    for k in range(0, len(pieces), at_once):
        own = slice(k, k + at_once)
        size = np.array([len(p) for p in pieces[own]])
        end = np.cumsum(size)
        begin = end - size
        data = np.frombuffer(b"".join(pieces[own]), np.uint8)
        sums = hasher.sums(data)
        # The anchor is the smallest of a piece's hashes, in the order of ``anchors``.
        place = np.arange(len(data) - GRAM + 1, dtype=np.uint64)
        mask = U((1 << 20) - 1)
        key = (hasher.at(sums, place.astype(np.int64), GRAM) & ~mask) | (mask - place)
        edges = np.column_stack([begin, end - GRAM + 1]).ravel()
        least = np.minimum.reduceat(np.append(key, ~U(0)), edges)[::2]
        place = (mask - (least & mask)).astype(np.int64)
        has_before[own], has_behind[own] = place - HALF >= begin, place + GRAM + HALF <= end
        for out, has, start in ((before, has_before, place - HALF), (behind, has_behind, place)):
            out[own][has[own]] = hasher.at(sums, start[has[own]], GRAM + HALF)
    out = np.zeros(len(pieces), bool)
    for side, has in ((before, has_before), (behind, has_behind)):
        _, same, count = np.unique(side[has], return_inverse=True, return_counts=True)
        out[has] |= count[same] > 1
    return out


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, n, digest, data): texts compressed, so that moving them costs less."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [text.encode("utf-8", "surrogatepass") for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"], "tag": batch["tag"], "n": [len(x) for x in raw],
                    "digest": [hashlib.sha256(x).hexdigest() for x in raw],
                    "data": [zstandard.compress(x, 3) for x in raw],
                }
            )

    return docs.mapInPandas(pack, "doc_id long, tag long, n long, digest string, data binary")


def _pair(high: str, low: Column | str) -> Column:
    """Two numbers below 2^31 as one."""
    low = F.col(low) if isinstance(low, str) else low
    return F.shiftleft(F.col(high).cast("long"), 32).bitwiseOR(low.cast("long"))


def pieces(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(block, hot, doc_id, tag, start, piece): the bytes of the strings of each repeated anchor."""
    hot = places.where("low < 0").select("h", F.ceil(F.col("copies") / HOT).alias("lanes"))
    places = places.where("low >= 0").join(hot, "h", "left")
    place = F.struct("low", "high", "h", F.coalesce("lanes", F.lit(1)).alias("lanes"))
    listed = places.groupBy("doc_id", "tag").agg(F.collect_list(place).alias("places"))
    listed = listed.select("doc_id", "tag", *[F.col("places")[name].alias(name) for name in ("low", "high", "h", "lanes")])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                if (row.doc_id, row.tag) == before:  # an equal row has the same pieces
                    continue
                before = row.doc_id, row.tag
                data = zstandard.decompress(row.data)
                _, once = np.unique(row.low, return_index=True)
                lanes = row.lanes[once].astype(np.uint64)
                lane = U((row.doc_id * 2654435761 + row.tag) % 2**31) % lanes
                block = (_mix(row.h[once].astype(np.uint64) + lane * U(BASE)) >> U(24)).astype(np.int64)
                spans = zip(block.tolist(), (lanes > 1).tolist(), row.low[once].tolist(), row.high[once].tolist(), strict=True)
                rows += [(b, hot, row.doc_id, row.tag, low, data[low : high + LENGTH]) for b, hot, low, high in spans]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    names = ["block", "hot", "doc_id", "tag", "start", "piece"]
    joined = texts.select("doc_id", "tag", "data").join(listed, ["doc_id", "tag"])
    return joined.mapInPandas(cut, "block long, hot boolean, doc_id long, tag long, start long, piece binary")


def covered(found: DataFrame, blocks: int) -> DataFrame:
    """(doc_id, tag, low, high): runs of starts whose string also starts in an earlier document."""

    def sort_block(block: pd.DataFrame) -> pd.DataFrame:
        codes, unique = pd.factorize(block["piece"])
        doc = block["doc_id"].to_numpy()
        size = np.array([len(p) for p in unique])
        low = np.full(len(unique), LAST_ID)
        np.minimum.at(low, codes, doc)
        count = size - LENGTH + 1
        begins = np.cumsum(count) - count
        inside = np.zeros(int(count.sum()), bool)
        # Strings of different anchors differ, so an anchor with a single piece needs no sorting.
        anchor = np.zeros(len(unique), np.int64)
        anchor[codes] = block["block"].to_numpy()
        _, kind, pieces_of = np.unique(anchor, return_inverse=True, return_counts=True)
        several = np.flatnonzero(pieces_of[kind] > 1)
        several = several[alike(unique[several])]
        if len(several):
            begin = np.cumsum(size[several]) - size[several]
            text = np.frombuffer(b"".join(unique[several]) + bytes(4 * LENGTH), np.uint8)
            owner = np.repeat(np.arange(len(several)), count[several])
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(count[several]) - count[several], count[several])
            group = equal_strings(text, int(size[several].sum()), begin[owner] + offset)
            lowest = np.full(group.max() + 1, LAST_ID)
            np.minimum.at(lowest, group, low[several][owner])
            inside[begins[several][owner] + offset] = lowest[group] < low[several][owner]
        # All strings of a piece that an earlier document holds are covered; of its first ones, those
        # that an earlier document holds in another piece.
        whole = doc > low[codes]
        start, tag, hot = block["start"].to_numpy(), block["tag"].to_numpy(), block["hot"].to_numpy()
        out = [pd.DataFrame({"doc_id": doc[whole], "tag": tag[whole], "low": start[whole], "high": start[whole] + count[codes[whole]] - 1})]
        mod, other = np.zeros(len(inside), np.uint64), np.zeros(len(inside), np.uint64)
        if hot.any():
            shown = np.flatnonzero(np.bincount(codes, hot, len(unique)))
            at = np.concatenate([np.arange(begins[k], begins[k] + count[k]) for k in shown])
            data = np.concatenate([np.lib.stride_tricks.sliding_window_view(np.frombuffer(unique[k], np.uint8), LENGTH) for k in shown])
            values = _mix(np.arange(1, 257, dtype=np.uint64) * U(BASE))
            for k in range(LENGTH):
                byte = values[data[:, k]]
                mod[at], other[at] = _mix(mod[at] + byte), other[at] * U(BASE) + byte
        rows, open_rows = [], []
        shows = np.logical_or.reduceat(inside, begins)[codes] | hot
        for i in np.flatnonzero(~whole & shows):
            piece = codes[i]
            own = slice(begins[piece], begins[piece] + count[piece])
            flags = np.concatenate([[0], inside[own].view(np.int8), [0]])
            edge = np.flatnonzero(np.diff(flags))
            rows += [(doc[i], tag[i], start[i] + a, start[i] + b - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]
            if hot[i]:
                rest = np.flatnonzero(~inside[own])
                open_rows += [
                    (doc[i], tag[i], start[i] + k, start[i] + k, x, y)
                    for k, x, y in zip(rest, mod[own][rest].view(np.int64), other[own][rest].view(np.int64), strict=True)
                ]
        out.append(pd.DataFrame(rows, columns=names[:4]))
        out.append(pd.DataFrame(open_rows, columns=names))
        result = pd.concat([x for x in out if len(x)] or [out[2]])
        return result.reindex(columns=names).astype({"x": "Int64", "y": "Int64"})

    names = ["doc_id", "tag", "low", "high", "x", "y"]
    schema = "doc_id long, tag long, low long, high long, x long, y long"
    runs = found.withColumn("part", F.pmod("block", F.lit(blocks))).groupBy("part").applyInPandas(
        lambda block: sort_block(block), schema
    )
    runs = staged(runs, "runs")
    open_runs = runs.where("x is not null")
    lowest = open_runs.groupBy("x", "y").agg(F.min("doc_id").alias("lowest"))
    late = open_runs.join(lowest, ["x", "y"]).where("doc_id > lowest")
    return runs.where("x is null").select(names[:4]).unionByName(late.select(names[:4]))


def dedupe(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256) per row; spans are the removed runs [start, end)."""
    keyed = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"), text_or_empty().alias("text"))
    keyed = keyed.withColumn("tag", F.xxhash64("text"))
    places = staged(repeated_places(keyed), "places")
    compared = places.where("h >= 0")
    blocks = max(1, compared.count() // BLOCK_PIECES)
    runs = covered(pieces(packed_texts(keyed), compared), blocks)
    runs = runs.unionByName(places.where("h < 0").select("doc_id", "tag", "low", "high"))
    listed = runs.groupBy("doc_id", "tag").agg(F.collect_list(_pair("low", "high")).alias("runs"))

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.runs is None:
                    out.append((row.doc_id, row.n, [], row.digest))
                    continue
                change = np.zeros(row.n + 1, np.int64)
                pairs = np.unique(np.asarray(row.runs))
                np.add.at(change, pairs >> 32, 1)
                np.add.at(change, (pairs & (2**32 - 1)) + LENGTH, -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                kept = np.frombuffer(zstandard.decompress(row.data), np.uint8)[~gone].tobytes()
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
                out.append((row.doc_id, row.n, spans, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept_sha256"])

    rows = packed_texts(keyed).join(listed, ["doc_id", "tag"], "left")
    done = rows.mapInPandas(
        remove, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string"
    )
    return done.withColumn("doc_id", F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")))


def report(docs: DataFrame) -> DataFrame:
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return dedupe(docs).select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )
