"""Exact token counts of every prefix.

The vocabulary drops white space before it merges, so no token crosses ASCII white space, and the count of a text is the
sum over its white-space-separated pieces. The operator keeps the running sum: entry i of `counts` is the exact count of the
prefix that ends with piece i, at code point `ends[i]`. Questions about budgets and truncation are searches in these arrays.
A prefix that ends inside a piece adds that piece's own prefix counts, which `Merges` computes for all its prefixes in one pass;
`fits` and `within` include them.

Nulls are empty texts: no tokens, no prefixes. Repeated rows give repeated results. A piece of any length and script costs its length,
up to the budget that is asked for. An empty table gives an empty result; only the two named columns are read, so others may
have any name.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
KEPT_PIECES, LONGEST_KEPT = 400_000, 64  #: a worker's store of piece counts; beyond it pieces are counted anew

#: fixed value: how the tokenizer divides normalised text into words
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"


def _byte_letters() -> list[str]:
    """The character by which byte-level vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Counter:
    """Counts of pieces, remembered per worker process."""

    def __init__(self, vocabulary: str):
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.known: dict[bytes, int] = {}
        self.special = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or "(?!)")
        self.merged: Merges | None = None

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        known = self.known
        out = list(map(known.get, pieces))
        if None in out:
            new = list({p for p, c in zip(pieces, out, strict=True) if c is None})
            fresh = {}
            for i in range(0, len(new), 2000):
                part = new[i:i + 2000]
                encoded = self.library.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
                fresh.update((p, len(e.ids)) for p, e in zip(part, encoded, strict=True))
            out = [fresh[p] if c is None else c for p, c in zip(pieces, out, strict=True)]
            if len(known) > KEPT_PIECES:
                known.clear()
            known.update((p, c) for p, c in fresh.items() if len(p) <= LONGEST_KEPT)
        return np.array(out, np.int64)

    def prefix_counts(self, piece: str, limit: float = math.inf) -> np.ndarray:
        """Tokens of each prefix of a piece; the array may end where all that follow have more than `limit`."""
        if self.merged is None:
            self.merged = Merges(self.library)
        return self.merged.prefix_counts(piece, self.special, self._count, limit)

    def longest_within(self, piece: str, limit: int) -> int:
        """Code points of the longest prefix of a piece that has at most `limit` tokens."""
        counts = self.prefix_counts(piece, limit)
        fit = np.flatnonzero(counts <= limit)
        return int(fit[-1]) + 1 if len(fit) else 0

    def _count(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)


class Merges:
    """Exact counts of all prefixes of a word, by dynamic programming over its symbols.

    The encoding of a prefix is the encoding of a shorter one and a last token, and of the tokens that the prefix could end with
    exactly one goes together with the shorter one's last: two neighbours go together if no merge across their border
    would have come before the merges that made them. So a row per symbol, its last token and count, gives every count in one
    pass: linear in the word, whatever the script. A prefix that is cut off ends as a word does, with END on its last symbol.
    """

    def __init__(self, library):
        import json

        import regex

        model = json.loads(library.to_str())["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.made: dict[str, tuple[int, str, str]] = {}
        for i, (left, right) in enumerate(pairs):
            self.made.setdefault(left + right, (i, left, right))
        self.known = set(model["vocab"])
        self.shown = _byte_letters()
        self.longest = max(len(t.removesuffix(END)) for t in self.known)
        self.words = regex.compile(WORD)
        if not _BLANK:
            spaces = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]
            _BLANK.update(c for c in spaces if not library.encode(c, add_special_tokens=False).ids)
        self.fits: dict[tuple[str, str], bool] = {}
        self.wholes: dict[str, bool] = {}

    def together(self, left: str, right: str) -> bool:
        """Whether the two tokens stay apart beside each other: the merges that made them are undone from the last one on, and no
        pair that then meets at the border may have been merged earlier."""
        key = (left, right)
        if (found := self.fits.get(key)) is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            found = self.fits[key] = self._together(left, right)
        return found

    def _together(self, left: str, right: str) -> bool:
        none = (-1, "", "")
        before = math.inf
        while True:
            if self.rank.get((left, right), math.inf) < before:
                return False
            a, b = self.made.get(left, none), self.made.get(right, none)
            if a[0] < 0 and b[0] < 0:
                return True
            if a[0] > b[0]:
                before, left = a[0], a[2]
            else:  # of equal pairs the one further left is merged first: the border is left of this one
                before, right = b[0] + 1, b[1]

    def _last(self, text: str, at: int, end: str, lasts: list[str | None]) -> tuple[int, str]:
        """(where it begins, the last token) of the symbols before `at`, closed by `end`."""
        for begin in range(max(0, at - self.longest), at):
            token = text[begin:at] + end
            if token in self.known and self._whole(token) and (begin == 0 or self.together(lasts[begin], token)):
                return begin, token
        return at - 1, text[at - 1:at] + end

    def _whole(self, token: str) -> bool:
        """Whether the token's own symbols are merged into it."""
        if (found := self.wholes.get(token)) is None:
            body = token.removesuffix(END)
            parts = [*body[:-1], body[-1:] + token[len(body):]]
            while len(parts) > 1:
                rank, at = min((self.rank.get(pair, math.inf), i) for i, pair in enumerate(zip(parts[:-1], parts[1:], strict=True)))
                if rank == math.inf:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            found = self.wholes[token] = len(parts) == 1
        return found

    def word_counts(self, word: str, room: float = math.inf) -> list[int]:
        """For each prefix of a word of letters or marks, in code points; it may end where all later counts are above `room`.

        A row points back by a token's length at most, so no later count is below the least of that many last rows."""
        symbols, ends = [], []
        for c in word:
            symbols += [self.shown[b] for b in c.encode()]
            ends.append(len(symbols))
        text, stops, out = "".join(symbols), set(ends), []
        lasts: list[str | None] = [None]
        inner = [0]
        for at in range(1, len(text) + 1):
            if at in stops:
                begin, _ = self._last(text, at, END, lasts)
                out.append(inner[begin] + 1)
                if inner[-1] > room and min(inner[-self.longest:]) >= room:
                    break
            begin, token = self._last(text, at, "", lasts)
            lasts.append(token)
            inner.append(inner[begin] + 1)
        return out

    def prefix_counts(self, piece: str, special, count, limit: float = math.inf) -> np.ndarray:
        """Tokens of each prefix of a piece without white space, up to a place behind which all have more than `limit`. `count` asks
        the library, where a cut falls into a special string, a contraction or a character that normalisation changes with its
        neighbours; all these are short, but for endless runs of combining marks."""
        out, base, at = [], 0, 0
        for gap in [*special.finditer(piece), None]:
            begin, end = gap.span() if gap else (len(piece), len(piece))
            runs, first, inside = list(_runs(piece, at, begin)) if base <= limit else [], base, base
            for a, b in runs:
                first = base
                counts = self._run_counts(piece[a:b], count, limit - base)
                out += [base + c for c in counts]
                base += counts[-1]
                if len(counts) < b - a or base > limit:
                    return np.array(out, np.int64)
            if gap:  # cut inside, the string is plain text that goes on with the run before it
                near = piece[runs[-1][0]:begin] if runs else ""
                inside = first if runs else base
                out += [inside + count(near + piece[begin:k]) for k in range(begin + 1, end)] + [base + 1]
                base += 1
                if base > limit:
                    break
            at = end
        return np.array(out, np.int64)

    def _run_counts(self, run: str, count, room: float) -> list[int]:
        if set(run) <= _BLANK:
            return [0] * len(run)
        lowered = [c.lower() for c in run]
        text = "".join(lowered)
        changes = len(text) != len(run) or not unicodedata.is_normalized("NFC", run) or not unicodedata.is_normalized("NFC", text)
        if "'" not in run and (changes or len({_kind(c) for c in text}) > 1):
            return self._cluster_counts(run, room)
        if changes or not _BLANK.isdisjoint(run):
            return [count(run[:k]) for k in range(1, len(run) + 1)]
        out, base = [], 0
        for m in self.words.finditer(text):
            word = m[0]
            if word[0] == "'" and len(word) > 1 and word[1].isalpha():  # a contraction
                counts = [count(word[:k]) for k in range(1, len(word) + 1)]
            else:
                counts = self.word_counts(word, room - base)
            out += [base + c for c in counts]
            base += counts[-1]
            if len(counts) < len(word):
                break
        return out

    def _cluster_counts(self, run: str, room: float) -> list[int]:
        """The same where normalisation joins characters: a cut inside a cluster goes on from the rows before the cluster."""
        starts = [i for i, c in enumerate(run) if i == 0 or not (c in _JOINING or unicodedata.combining(c))]
        out: list[int] = []
        base, kind, text, lasts, inner = 0, "", "", [None], [0]

        def closed() -> int:
            return inner[self._last(text, len(text), END, lasts)[0]] + 1 if text else 0

        for begin, end in zip(starts, [*starts[1:], len(run)], strict=True):
            held = base, kind, text, lasts, inner
            rows = len(lasts)
            for k in range(begin + 1, end + 1):
                base, kind, text, lasts, inner = held
                del lasts[rows:], inner[rows:]
                for c in "".join(c.lower() for c in unicodedata.normalize("NFC", run[begin:k])):
                    own = _kind(c)
                    if own != kind or own == "N":
                        base, kind, text, lasts, inner = base + closed(), own, "", [None], [0]
                    for b in c.encode() if own != "S" else b"":
                        text += self.shown[b]
                        first, token = self._last(text, len(text), "", lasts)
                        lasts.append(token)
                        inner.append(inner[first] + 1)
                out.append(base + closed())
            if out[-1] > room and base + min(inner[-self.longest:]) >= room:
                break
        return out


def _kind(c: str) -> str:
    """Letter, number, space or mark, as words are divided."""
    first = unicodedata.category(c)[0]
    return first if first in "LN" else "S" if c in _BLANK else "M"


def _joining() -> set[str]:
    """Characters that normalisation may join with one before them."""
    pairs = (unicodedata.decomposition(chr(i)).split() for i in range(sys.maxunicode + 1))
    return {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")} | {chr(i) for i in range(0x1160, 0x1200)}


_JOINING: set[str] = set()
_BLANK: set[str] = set()  #: what the tokenizer drops as white space


def _runs(text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """Spans between places where a word begins whatever stands around them: normalisation can't reach across, and the kinds of
    the characters differ. An apostrophe may begin a contraction, so nothing begins behind one."""
    if not _JOINING:
        _JOINING.update(_joining())
    begin = start
    for i in range(start + 1, stop):
        left, right = text[i - 1], text[i]
        if left == "'" or right in _JOINING or unicodedata.combining(right):
            continue
        a, b = _kind(left.lower()[-1]), _kind(right.lower()[0])
        if left in _JOINING or unicodedata.combining(left):  # it may have become part of a letter or a mark
            a = b if b in "LM" else "?"
        if a != b or a == "N":
            yield begin, i
            begin = i
    if stop > start:
        yield begin, stop


def _prefixes(text: str, counter: Counter, block: int = 200_000) -> tuple[list[bytes], np.ndarray]:
    pieces = text.encode().split()
    parts = [counter.counts(pieces[i:i + block]) for i in range(0, len(pieces), block)]
    return pieces, np.cumsum(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def _ends(text: str, pieces: list[bytes]) -> np.ndarray:
    """Code points up to the end of each piece."""
    at, out = 0, np.empty(len(pieces), np.int64)
    for i, p in enumerate(pieces):
        piece = p.decode()
        at = text.index(piece, at) + len(piece)
        out[i] = at
    return out


def _counted(vocabulary: str, limits: tuple[int, ...], keep: bool, offsets: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            n_bytes, n_tokens, fits, within, ends, counts = [], [], [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                pieces, running = _prefixes(text, counter)
                total = int(running[-1]) if len(running) else 0
                n_bytes.append(len(text.encode()))
                n_tokens.append(total)
                cut = [int(np.searchsorted(running, limit, "right")) for limit in limits]
                where = _ends(text, pieces[:max(cut, default=0) + 1] if not keep and not offsets else pieces)
                fit = []
                for c, limit in zip(cut, limits, strict=True):
                    if c == len(running):
                        fit.append(len(text))
                        continue
                    piece = pieces[c].decode()  # the first that doesn't fit as a whole; white space before it is free
                    fit.append(int(where[c]) - len(piece) + counter.longest_within(piece, limit - (int(running[c - 1]) if c else 0)))
                fits.append(fit)
                inside = []
                for chars in offsets:
                    c = int(np.searchsorted(where, chars, "right"))
                    begin = int(where[c]) - len(pieces[c].decode()) if c < len(pieces) else chars
                    part = counter.counts([pieces[c].decode()[:chars - begin].encode()])[0] if begin < chars else 0
                    inside.append((int(running[c - 1]) if c else 0) + int(part))
                within.append(inside)
                if keep:
                    ends.append(where)
                    counts.append(running)
            arrays = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(fits, pa.list_(pa.int64()))]
            names = ["id", "n_bytes", "n_tokens", "fits"]
            for name, x in [("ends", ends), ("counts", counts)] * keep + [("within", within)] * bool(offsets):
                arrays.append(pa.array(x, pa.list_(pa.int64())))
                names.append(name)
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def token_prefixes(docs: DataFrame, vocabulary: str = VOCABULARY, limits: tuple[int, ...] = (), keep: bool = True,
                   id_col: str = "doc_id", text_col: str = "text", offsets: tuple[int, ...] = ()) -> DataFrame:
    """(id, n_bytes, n_tokens, fits[, ends, counts][, within]) per row of `docs`. `fits[i]` is the number of code points of the
    longest prefix, of any end, within limits[i] tokens; `keep` also returns the prefix arrays themselves. `within[i]` is the exact
    count of the first offsets[i] code points, also inside a piece."""
    kinds = "id long, n_bytes long, n_tokens long, fits array<long>" + ", ends array<long>, counts array<long>" * keep + ", within array<long>" * bool(offsets)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _counted(vocabulary, tuple(limits), keep, tuple(offsets)), kinds)


def count_within(chars: Column | int) -> Column:
    """Exact count of the longest stored prefix of at most `chars` code points, from the kept arrays, which end at pieces; for
    ends inside a piece use `offsets` of `token_prefixes`."""
    chars = F.lit(chars) if isinstance(chars, int) else chars
    inside = F.size(F.filter("ends", lambda e: e <= chars))
    return F.when(inside > 0, F.element_at("counts", inside)).otherwise(F.lit(0))


def budget_end(tokens: Column | int) -> Column:
    """Code points of the longest stored prefix within a budget of tokens, from the kept arrays, which end at pieces; for ends
    inside a piece use `limits` of `token_prefixes`."""
    tokens = F.lit(tokens) if isinstance(tokens, int) else tokens
    inside = F.size(F.filter("counts", lambda c: c <= tokens))
    return F.when(inside > 0, F.element_at("ends", inside)).otherwise(F.lit(0))


def piece_prefixes(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """(piece, counts): each distinct piece of the texts, with the exact count of each of its prefixes (1, 2, ... code points)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            pieces = batch.column(0).to_pylist()
            counts = [counter.prefix_counts(p) for p in pieces]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.list_(pa.int64()))], names=["piece", "counts"])

    pieces = docs.select(F.explode(F.split(text_col, r"[ \t-\r]+")).alias("piece")).where("piece != ''").distinct()
    return pieces.mapInArrow(run, "piece string, counts array<long>")
