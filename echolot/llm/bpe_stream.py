"""BPE encoding and decoding: bounded-lookahead streaming transducer.

Encoding reads the symbols of a word one by one. The encoding of a prefix ends in a token that is the
only one fitting to the encoding of what stands before it, so one token per position is kept, found
among the tokens that end there. Any later encoding runs through one of the last ``lookahead``
positions, the length of the longest token that the merge list makes. Once the chains of tokens from
these positions have met, everything before the meeting point is stable and is emitted. Thus memory
depends on the merge list and not on the text. A symbol is read one step late, because the last one of
a word carries the end mark.

Two neighbouring tokens fit if the merge list, applied to the symbols of both, keeps them apart, which the
tokens at their meeting edges decide; answers are remembered. Words are remembered too, all up to a bound: an
executor may hold several idle workers, each with an encoder, beside those that run.

Decoding feeds the bytes of each token to an incremental UTF-8 machine, which holds at most an
unfinished character; with a byte-level alphabet it gives back the text, without a decoder in the
tokenizer file it gives the tokens' spelling with spaces between. Null texts count as empty.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolot.llm.common import text_or_empty

#: Answers that are remembered: pairs of tokens, beginnings of words, and words by their symbols, ``ENTRY`` more each.
PAIRS = 200_000
HEADS = 150_000
ENTRY = 16
SYMBOLS = 250_000 * (ENTRY + 8)
SEPARATORS = re.compile("[\x1c-\x1f]")
WINDOW = 1 << 16
STEP = 64
TAIL = 3
Ids = tuple[int, ...]
SHORT = range(TAIL - 1, 0, -1)
#: White space of the Unicode property, as the tokenizer's expressions have it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Spec(NamedTuple):
    """What a tokenizer file says, as plain values that travel to the tasks."""

    vocab: dict[str, int]
    merges: list[tuple[str, str]]
    end: str
    special: dict[str, int]
    pattern: str


def load(path: str) -> Spec:
    """Reads a tokenizer file on the driver: BPE over a byte-level alphabet with an end-of-word mark."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model = data["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    splits = data["pre_tokenizer"]["pretokenizers"]
    pattern = next(p["pattern"]["Regex"] for p in splits if p["type"] == "Split")
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    return Spec(model["vocab"], merges, model["end_of_word_suffix"] or "", special, pattern)


class Merges:
    """The merge list over token ids, and what follows from it."""

    def __init__(self, spec: Spec) -> None:
        vocab, self.end = spec.vocab, spec.end
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for i, (a, b) in enumerate(spec.merges):
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            self.rank.setdefault(pair, (i, made))
            self.parts.setdefault(made, pair)
        never = len(spec.merges)
        # The tokens at the right (left) edge of a token while it is being made, each with the
        # rank of the merge that uses it up.
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        sizes: dict[int, int] = {}
        self.made: dict[str, int] = {}
        for token in vocab.values():
            if token not in self.parts:
                self.right[token] = self.left[token] = [(token, never)]
        spelling = {i: t for t, i in vocab.items()}
        self.made.update((spelling[t], t) for t in self.right)
        for made, (a, b) in self.parts.items():  # in the order of the list: parts come first
            rank = self.rank[a, b][0]
            self.right[made] = [(made, never)] + [x if x[1] <= rank else (x[0], rank) for x in self.right[b]]
            self.left[made] = [(made, never)] + [x if x[1] <= rank else (x[0], rank) for x in self.left[a]]
            sizes[made] = sizes.get(a, 1) + sizes.get(b, 1)
            if self.made.get(spelling[a]) == a and self.made.get(spelling[b]) == b and self.apart(a, b, rank):
                self.made[spelling[made]] = made
        #: Symbols that decide the next token: the longest token of the merge list.
        self.lookahead = max(sizes.values(), default=1)
        self.fits_memo: dict[tuple[int, int], bool] = {}
        self.ends_memo: dict[str, tuple[int, int]] = {}
        self.sizes, self.end_sizes = self._sizes(""), self._sizes(self.end)

    def _sizes(self, mark: str) -> dict[str, list[int]]:
        """By a token's last ``TAIL`` symbols before a mark: how many symbols such tokens have, longest first,
        and all smaller numbers."""
        found: dict[str, set[int]] = {}
        for token in self.made:
            n = len(token) - len(mark)
            if token.endswith(mark) and TAIL <= n <= self.lookahead:
                found.setdefault(token[n - TAIL : n], set()).add(n)
        return {tail: sorted(sizes | set(range(1, TAIL)), reverse=True) for tail, sizes in found.items()}

    def apart(self, a: int, b: int, before: int) -> bool:
        """Whether no merge of a rank below ``before`` joins the edges of two neighbours.

        A merge across happens if both edge tokens exist at its rank. At equal rank the leftmost
        goes first: one inside ``a`` before it, one inside ``b`` after it.
        """
        for r, r_gone in self.right[a]:
            for l, l_gone in self.left[b]:
                found = self.rank.get((r, l))
                if found and found[0] < before and found[0] < r_gone and found[0] <= l_gone:
                    return False
        return True

    def fits(self, a: int, b: int) -> bool:
        """Whether the merge list, applied to the symbols of both, leaves the two tokens."""
        got = self.fits_memo.get((a, b))
        if got is None:
            got = self.apart(a, b, len(self.rank) + 1)
            if len(self.fits_memo) >= PAIRS:
                self.fits_memo.clear()
            self.fits_memo[a, b] = got
        return got


class Transducer:
    """Encodes one word; ``feed`` returns the tokens that have become stable, ``finish`` the rest."""

    def __init__(self, merges: Merges) -> None:
        self.m = merges
        self.text = ""  # symbols since the last stable boundary; the last one waits
        self.last: dict[int, tuple[int, int]] = {}  # by position: token that ends there, its length

    def feed(self, symbols: str) -> list[int]:
        self.text += symbols
        if len(self.text) <= 4 * self.m.lookahead:
            return []
        return self._stable(len(self.text) - 1)

    def finish(self) -> list[int]:
        return self._take(len(self.text), self.m.end) if self.text else []

    def _ends(self, n: int, mark: str = "") -> tuple[int, int]:
        """The token that ends the encoding of the first n symbols; worked out when asked for.

        It depends on these symbols alone, so short ones are remembered for other words that begin so.
        """
        last, m = self.last, self.m
        head = self.text[:n]
        if mark:
            text, sizes = head + mark, m.end_sizes
        else:
            if (got := last.get(n) or m.ends_memo.get(head)) is not None:
                last[n] = got
                return got
            text, sizes = head, m.sizes
        made, known = m.made, m.fits_memo
        for size in sizes.get(head[-TAIL:], SHORT):
            if (at := n - size) < 0 or (token := made.get(text[at:])) is None:
                continue
            if at:
                before = (last.get(at) or self._ends(at))[0]
                fit = known.get((before, token))
                if not (m.fits(before, token) if fit is None else fit):
                    continue
            if not mark:
                last[n] = token, size
                if n <= m.lookahead:
                    if len(m.ends_memo) >= HEADS:
                        m.ends_memo.clear()
                    m.ends_memo[head] = last[n]
            return token, size
        raise ValueError(f"the vocabulary has no token for {text[n - 1]!r}")

    def _take(self, upto: int, mark: str = "") -> list[int]:
        """Tokens of the chain that ends at a position; what they cover is forgotten."""
        out, at = [], upto
        while at > 0:
            token, size = self._ends(at, mark if at == upto else "")
            out.append(token)
            at -= size
        self.text = self.text[upto:]
        self.last = {n - upto: got for n, got in self.last.items() if n > upto} if self.text else {}
        return out[::-1]

    def _stable(self, known: int) -> list[int]:
        """Tokens before the place where the chains from the last positions meet.

        The token that ends there stays behind as the neighbour of the next one.
        """
        for n in range(1, known + 1):
            self._ends(n)
        heads = set(range(known - self.m.lookahead + 1, known + 1))
        while len(heads) > 1:
            far = max(heads)
            heads.remove(far)
            heads.add(far - self._ends(far)[1])
        meet = heads.pop()
        if meet <= 0 or (keep := meet - self._ends(meet)[1]) <= 0:
            return []
        return self._take(keep)


class Several(tuple):
    """Ids of what holds several words, or none."""

    __slots__ = ()


class Memory:
    """Ids by word in two generations: a full one becomes the old one, whose words come back when met again."""

    def __init__(self, symbols: int) -> None:
        self.symbols, self.held = symbols, 0
        self.new: dict[str, Ids] = {}
        self.old: dict[str, Ids] = {}

    def turn(self) -> None:
        """Makes room, if need be."""
        if self.held > self.symbols:
            self.new, self.old, self.held = {}, self.new, 0

    def get(self, word: str) -> Ids | None:
        got = self.new.get(word)
        return self.old.get(word) if got is None else got

    def put(self, word: str, ids: Ids) -> None:
        self.new[word] = ids
        self.held += ENTRY + len(word)


class Encoder:
    def __init__(self, spec: Spec) -> None:
        self.merges = Merges(spec)
        self.special = spec.special
        self.alphabet = dict(enumerate(byte_alphabet()))
        marks = "|".join(map(re.escape, sorted(spec.special, key=len, reverse=True)))
        self.marks = re.compile(f"({marks})") if marks else None
        self.words = regex.compile(spec.pattern.replace(r"\s", SPACE))
        self.spaces = re.compile(f"[{SPACE}]")
        # What stands between white space, and words of those that hold several.
        self.runs, self.parts = Memory(SYMBOLS), Memory(SYMBOLS // 2)

    def word(self, word: str) -> list[int]:
        run, data = Transducer(self.merges), word.encode("utf-8", "surrogatepass")
        out = []
        for at in range(0, len(data), STEP):
            out += run.feed(data[at : at + STEP].decode("latin-1").translate(self.alphabet))
        return out + run.finish()

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, window by window; windows end before white space."""
        for i, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if i % 2:
                yield [self.special[part]]
                continue
            at = 0
            while at < len(part):
                end = at + WINDOW
                if end < len(part):
                    gap = self.spaces.search(part, end)
                    end = gap.start() if gap else len(part)
                yield self._window(part[at:end])
                at = end

    def _window(self, text: str) -> list[int]:
        # White space only parts words, so the tokenizer's folding of it to one space changes nothing.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # Python splits at four control characters more than the tokenizer does.
        runs = text.split() if SEPARATORS.search(text) is None else self.spaces.split(text)
        memory = self.runs
        memory.turn()
        known, old = memory.new, memory.old
        for run in set(runs).difference(known):
            got = old.get(run)
            memory.put(run, self._run(run) if got is None else got)
        return list(chain.from_iterable(map(known.__getitem__, runs)))

    def _run(self, run: str) -> Ids:
        """Ids of what stands between white space; its words are remembered too."""
        words, out, parts = self.words.findall(run), [], self.parts
        if words == [run]:
            ids = parts.get(run)
            return tuple(self.word(run)) if ids is None else ids
        parts.turn()
        for word in words:
            ids = parts.get(word)
            if ids is None:
                ids = self.runs.get(word)
                if ids is None or isinstance(ids, Several):
                    ids = tuple(self.word(word))
                parts.put(word, ids)
            out += ids
        return Several(out)


class Decoder:
    """Bytes of tokens to text; ``feed`` gives the text that is complete so far."""

    def __init__(self, pieces: dict[int, bytes], between: bytes) -> None:
        self.pieces, self.between, self.started = pieces, between, False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        data = self.between.join(map(self.pieces.__getitem__, ids))
        data, self.started = (self.between if self.started else b"") + data, True
        return self.machine.decode(data)

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


def spelled_pieces(spec: Spec) -> dict[int, bytes]:
    """Tokens as the vocabulary spells them."""
    return {i: t.encode() for t, i in chain(spec.vocab.items(), spec.special.items())}


def text_pieces(spec: Spec) -> dict[int, bytes]:
    """Tokens as bytes of text; the end mark becomes a space."""
    byte = {c: b for b, c in enumerate(byte_alphabet())}
    out = {i: t.encode() for t, i in spec.special.items()}
    for token, i in spec.vocab.items():
        ends = bool(spec.end) and token.endswith(spec.end)
        stem = token[: -len(spec.end)] if ends else token
        out[i] = bytes(byte[c] for c in stem) + (b" " if ends else b"")
    return out


def report(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of their decoding."""
    # Each worker puts its encoder in place of the file's contents and keeps it from task to task.
    shared = docs.sparkSession.sparkContext.broadcast({"spec": tuple(load(path))})

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kept = shared.value
        if "all" not in kept:
            spec = Spec(*kept["spec"])
            pieces = spelled_pieces(spec)
            kept["all"] = Encoder(spec), pieces, {i: str(i) for i in pieces}
            del kept["spec"], spec
        encoder, pieces, names = kept["all"]
        for batch in batches:
            out = []
            for text in batch:
                n, coded, decoded = 0, hashlib.sha256(), hashlib.sha256()
                decoder = Decoder(pieces, b" ")
                for ids in encoder.stream(text):
                    if not ids:
                        continue
                    coded.update((" " * bool(n) + " ".join(map(names.__getitem__, ids))).encode())
                    decoded.update(decoder.feed(ids).encode())
                    n += len(ids)
                decoded.update(decoder.finish().encode())
                out.append((n, coded.hexdigest(), decoded.hexdigest()))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select("doc_id", run(text_or_empty()).alias("_m"))
    return rows.select("doc_id", "_m.*")
