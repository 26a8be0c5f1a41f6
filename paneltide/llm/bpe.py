"""BPE encoding and decoding with a minimal acyclic transducer as lexicon (operator 5).

The most frequent words of the corpus are compiled, with their id sequences as output, into a
shared-suffix automaton: a word's path adds up the outputs on its edges to the word's rank, and the
rank points at its ids. Workers memory-map the compiled file. Words outside the lexicon are merged
exactly, lowest rank first. Ids are those of the tokenizer file; nothing is trained.

Defined results: a null text counts as empty (no ids, empty decoded text); very long texts and single
words are encoded whole, in about linear time; of equal merge ranks the leftmost goes first; repeated rows are each
encoded; extra columns are ignored, so their names can't clash; an empty table gives an empty result.
The special tokens' literal strings in a text become their ids, as in the reference library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import struct
import tempfile
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from . import common
from .common import cut, pieces

#: Fixed values of the tokenizer's pre-tokenizer: contractions, letter runs, single digits, symbol runs.
_SPACE = "\t-\r \x85\xa0  -     　"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: Separators to str.split() that aren't white space to the tokenizer.
_CONTROL = regex.compile("[\x1c-\x1f]")
#: Ranges that the regex module counts as letters or numbers and the tokenizer library, of an older Unicode version, as symbols.
_NEWER = regex.compile(
    "[\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1"
    "\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff"
    "\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168"
    "\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2"
    "\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f]"
)
#: Capitals that the library lowers and ``str.lower`` of Unicode 15.1 doesn't: first, last, distance of the small letter.
_LOWERED = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1),
    (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27),
)
_LOWER = {c: c + step for first, last, step in _LOWERED for c in range(first, last + 1)}
_CAPITAL = regex.compile("[" + "".join(map(chr, _LOWER)) + "]")
_ASIDE = _NEWER.pattern[1:-1]
_NEWER_WORD = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_ASIDE}]]+|[\p{{N}}--[{_ASIDE}]]|[[^{_SPACE}\p{{L}}\p{{N}}]||[{_ASIDE}]]+")
_BITS, _NEVER = 20, 1 << 60
_UNKNOWN = (1 << _BITS) - 1  # no vocabulary is that large
_LONG = 64  # bytes of a word beyond which merging runs on a heap
_TOGETHER = 100_000  # runs that are looked up, or merged, in one go
_FEW = 8  # words of one length up to which merging them together doesn't pay


def split_words(run: str) -> list[str]:
    """Words of a run without white space, as the tokenizer splits it."""
    if _letters(run):
        return [run]
    end = run[-1:]
    if end.isascii() and not (end.isalpha() or end.isspace()) and _letters(run[:-1]):
        return [run[:-1], end]
    return (_WORD if run.isascii() or not _NEWER.search(run) else _NEWER_WORD).findall(run)


def _latin(text: str) -> bool:
    """No code point beyond U+00FF: nothing to compose, and no capital that needs care."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def _letters(run: str) -> bool:
    """Surely nothing but letters to any version of Unicode: those below U+0250 have always been there."""
    return run.isalpha() and (run.isascii() or max(run) < "\u0250")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Transducer:
    """Read side of the compiled lexicon: word (bytes) -> rank, or -1."""

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(blob)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n_nodes, n_edges, n_words, n_ids = struct.unpack_from("<4q", self.map)
        at = 32

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(self.map, kind, n, at)
            at += out.nbytes
            return out

        self.first = take("<i4", n_nodes + 1)
        self.target = take("<i4", n_edges)
        self.output = take("<i4", n_edges)
        self.offset = take("<i4", n_words + 1)
        self.ids_at = at
        at += 4 * n_ids
        self.final = take("u1", n_nodes)
        self.labels_at = at
        self.n_words = n_words

    def rank(self, word: bytes) -> int:
        node = rank = 0
        find, base, first, target, output = self.map.find, self.labels_at, self.first, self.target, self.output
        for i in range(len(word)):
            e = find(word[i : i + 1], base + int(first[node]), base + int(first[node + 1]))
            if e < 0:
                return -1
            rank += int(output[e - base])
            node = int(target[e - base])
        return rank if self.final[node] else -1

    def ids(self, word: bytes) -> bytes | None:
        r = self.rank(word)
        return None if r < 0 else self.map[self.ids_at + 4 * int(self.offset[r]) : self.ids_at + 4 * int(self.offset[r + 1])]


def compile_lexicon(entries: dict[bytes, bytes]) -> bytes:
    """Word -> ids (little-endian uint32) as one file: a minimal acyclic automaton with rank outputs."""
    words = sorted(entries)
    # nodes that can't change any more are shared by (final, edges)
    register: dict[tuple, int] = {}
    done: list[tuple] = []

    def freeze(final: bool, edges: list) -> int:
        key = (final, tuple(edges))
        if key not in register:
            register[key] = len(done)
            done.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # open nodes along the last word: [final, edges]; the open child's label is in `last`
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(final, edges)))

    for w in words:
        common = 0
        while common < min(len(w), len(last)) and w[common] == last[common]:
            common += 1
        close(common)
        path.extend([False, []] for _ in w[common:])
        path[-1][0] = True
        last = w
    close(0)
    root = freeze(path[0][0], path[0][1])

    # children are frozen before parents, so counts of words below a node are ready in order
    below = np.zeros(len(done), np.int64)
    for i, (final, edges) in enumerate(done):
        below[i] = final + sum(int(below[t]) for _, t in edges)
    number = np.empty(len(done), np.int64)
    number[root] = 0
    rest = [i for i in range(len(done)) if i != root]
    number[rest] = np.arange(1, len(done))
    first, labels, target, output, finals = [0], bytearray(), [], [], bytearray()
    for i in [root, *rest]:
        final, edges = done[i]
        finals.append(final)
        passed = int(final)
        for label, t in edges:
            labels.append(label)
            target.append(int(number[t]))
            output.append(passed)
            passed += int(below[t])
        first.append(len(labels))
    ids = [entries[w] for w in words]
    offset = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype("<i4")
    arrays = [np.array(x, "<i4").tobytes() for x in (first, target, output)]
    head = struct.pack("<4q", len(done), len(labels), len(words), int(offset[-1]))
    return b"".join([head, *arrays, offset.tobytes(), *ids, bytes(finals), bytes(labels)])


#: Characters of the longest word or run that is cached.
_KEPT = 128


def _ranks(keys: np.ndarray, values: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The value of each pair among the sorted ``keys``."""
    if not len(keys):
        return np.full(len(pairs), _NEVER)
    at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
    return np.where(keys[at] == pairs, values[at], _NEVER)


class _Cache(dict):
    """Two generations of at most ``limit`` entries, and ``limit`` * 256 bytes, each: what was used since the last change of generation stays. Words of over ``_KEPT`` characters are made anew each time, which costs no more than making them once did."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old, self.bytes = make, limit, {}, 0

    def __missing__(self, word):
        if len(word) > _KEPT:
            return self.make(word)
        out = self.old.get(word)
        if out is None:
            out = self.make(word)
        self._room(1, 200 + 2 * len(word) + len(out))
        self[word] = out
        return out

    def keep_all(self, made: dict) -> None:
        """Takes what was made elsewhere, an eighth of a generation at a time."""
        entries, step = [(w, x) for w, x in made.items() if len(w) <= _KEPT], max(1, self.limit // 8)
        for at in range(0, len(entries), step):
            some = entries[at : at + step]
            self._room(len(some), sum([200 + 2 * len(w) + len(x) for w, x in some]))
            self.update(some)

    def _room(self, n: int, size: int) -> None:
        """Begins a generation where ``n`` entries of ``size`` bytes, with the objects' own, don't fit."""
        if len(self) + n > self.limit or self.bytes + size > 256 * self.limit:
            self.old, self.bytes = dict(self), 0
            self.clear()
        self.bytes += size


class WordBpe:
    """Exact encoder and decoder for a word-level BPE file; the lexicon only saves merging."""

    def __init__(self, tokenizer: bytes, lexicon: bytes | None = None, cache: int = 350_000):
        data = json.loads(tokenizer)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in self.specials) + ")")
        # a pair of ids as one number -> rank and id of what it merges to, also as one number
        pairs = ((m if isinstance(m, list) else m.split(" ")) for m in model["merges"])
        self.merges = {self.vocab[a] << _BITS | self.vocab[b]: rank << _BITS | self.vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        chars = byte_chars()
        self.inner, self.last = ([self.vocab.get(c + end, _UNKNOWN) for c in chars] for end in ("", self.end))
        self.tokens = [""] * (1 + max([*self.vocab.values(), *self.specials.values()]))
        for t, i in [*self.vocab.items(), *self.specials.items()]:
            self.tokens[i] = t
        self.lexicon = Transducer(lexicon) if lexicon else None
        self.words = _Cache(self.word_ids, cache)
        self.runs = _Cache(lambda run: b"".join(map(self.words.__getitem__, split_words(run))), cache)

    def merge(self, word: str) -> bytes:
        """Ids of one word: the pair of least rank is merged first, the leftmost of equal ones."""
        inner, bits = self.inner, word.encode()
        ids = [inner[b] for b in bits]
        ids[-1] = self.last[bits[-1]]
        rank = self.merges.get
        if len(ids) > _LONG:
            return self._merge_long(ids)
        ranks = [rank(a << _BITS | b, _NEVER) for a, b in pairwise(ids)]
        while ranks and (best := min(ranks)) != _NEVER:
            i = ranks.index(best)
            ids[i] = made = best & _UNKNOWN
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(made << _BITS | ids[i + 1], _NEVER)
            if i:
                ranks[i - 1] = rank(ids[i - 1] << _BITS | made, _NEVER)
        if _UNKNOWN in ids:
            ids = [x for x in ids if x != _UNKNOWN]
        return struct.pack(f"<{len(ids)}I", *ids)

    @cached_property
    def _pairs(self) -> tuple[np.ndarray, ...]:
        """``merges`` as sorted arrays, and the ranks of two bytes inside a word and at its end."""
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        order = np.argsort(keys)
        keys, values = keys[order], np.fromiter(self.merges.values(), np.int64, len(keys))[order]
        inner, last = np.array(self.inner, np.int64), np.array(self.last, np.int64)
        first = (_ranks(keys, values, (inner[:, None] << _BITS | other).ravel()) for other in (inner, last))
        return keys, values, inner, last, *first

    def merge_all(self, words: Sequence[str]) -> list[bytes]:
        """``merge`` of each word: words of equal length go together, and each step merges one pair of every word that has one left."""
        out: list = [None] * len(words)
        lengths: dict[int, list[int]] = {}
        coded = [w.encode() for w in words]
        for i, c in enumerate(coded):
            lengths.setdefault(len(c), []).append(i)
        for n, own in lengths.items():
            if n > _LONG or len(own) <= _FEW:
                for i in own:
                    out[i] = self.merge(words[i])
            else:
                for at in range(0, len(own), 1 << 16):
                    some = own[at : at + (1 << 16)]
                    self._merge_equal(np.frombuffer(b"".join(coded[i] for i in some), np.uint8).reshape(len(some), n), np.array(some), out)
        return out

    def _merge_equal(self, bits: np.ndarray, place: np.ndarray, out: list) -> None:
        """Ids of the words whose bytes are the rows of ``bits`` go to ``out`` at ``place``."""
        keys, values, inner, last, within, at_end = self._pairs
        ids, pairs = inner[bits], bits[:, :-1].astype(np.int64) << 8 | bits[:, 1:]
        ids[:, -1] = last[bits[:, -1]]
        ranks = within[pairs]
        ranks[:, -1:] = at_end[pairs[:, -1:]]
        while True:
            rows, width = ids.shape
            at = ranks.argmin(1) if width > 1 else np.zeros(rows, np.int64)  # the leftmost of equal ones
            best = ranks[np.arange(rows), at] if width > 1 else np.full(rows, _NEVER)
            ready = best == _NEVER
            if ready.any():
                known = ids[ready]
                whole = known.astype("<u4").tobytes()
                for k, (i, lost) in enumerate(zip(place[ready].tolist(), (known == _UNKNOWN).any(1).tolist(), strict=True)):
                    own = known[k]
                    out[i] = own[own != _UNKNOWN].astype("<u4").tobytes() if lost else whole[4 * width * k : 4 * width * (k + 1)]
                if ready.all():
                    return
                ids, ranks, place, at, best = (x[~ready] for x in (ids, ranks, place, at, best))
                rows = len(ids)
            row = np.arange(rows)
            ids[row, at] = best & _UNKNOWN
            left, right = np.ones(ids.shape, bool), np.ones(ranks.shape, bool)
            left[row, at + 1] = right[row, at] = False
            ids, ranks, width = ids[left].reshape(rows, -1), ranks[right].reshape(rows, -1), width - 1
            for near in (at, at - 1):
                r = np.flatnonzero((near >= 0) & (near < width - 1))
                c = near[r]
                ranks[r, c] = _ranks(keys, values, ids[r, c] << _BITS | ids[r, c + 1])

    def _merge_long(self, ids: list[int]) -> bytes:
        """The same order of merges from a heap over linked neighbours: n log n."""
        n, rank = len(ids), self.merges.get
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i) for i in range(n - 1) if (r := rank(ids[i] << _BITS | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or rank(ids[i] << _BITS | ids[j]) != r:
                continue  # one of the two has been merged away
            ids[i], ids[j] = r & _UNKNOWN, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank(ids[i] << _BITS | ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := rank(ids[before[i]] << _BITS | ids[i])) is not None:
                heapq.heappush(heap, (r, before[i]))
        kept = [x for x in ids if x >= 0 and x != _UNKNOWN]
        return struct.pack(f"<{len(kept)}I", *kept)

    def word_ids(self, word: str) -> bytes:
        known = self.lexicon.ids(word.encode()) if self.lexicon else None
        return self.merge(word) if known is None else known

    def _lowered(self, text: str) -> str:
        if not _latin(text):
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower() alone would apply the final-sigma rule
            if _CAPITAL.search(text):
                text = text.translate(_LOWER)
        return text.lower()

    def _plain(self, text: str) -> bytes:
        text = self._lowered(text)
        if _CONTROL.search(text):
            return b"".join(map(self.words.__getitem__, split_words(text)))
        return b"".join(map(self.runs.__getitem__, text.split()))  # no word crosses white space

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "<|" not in text:
            return self._plain(text)
        parts = self.special.split(text)
        return b"".join(struct.pack("<I", self.specials[p]) if i % 2 else self._plain(p) for i, p in enumerate(parts))

    def encode_all(self, texts: Sequence[str | None]) -> list[bytes]:
        """``encode`` of each text; the words of all runs that no cache holds are merged together, some ``_TOGETHER`` at a time."""
        out: list[list[bytes]] = [[] for _ in texts]
        late: list[tuple[list, int, list[str], list, list[int]]] = []
        missing: set[str] = set()

        def settle() -> None:
            new = self._encode_runs(missing)
            for parts, k, own, found, gaps in late:
                for g in gaps:
                    found[g] = new[own[g]]
                parts[k] = b"".join(found)
            self.runs.keep_all(new)
            late.clear()
            missing.clear()

        for parts, t in zip(out, texts, strict=True):
            if not t or "<|" in t or _CONTROL.search(t):
                parts.append(self.encode(t))
                continue
            runs = self._lowered(t).split()
            for at in range(0, len(runs), _TOGETHER):
                own = runs[at : at + _TOGETHER]
                found = list(map(self.runs.get, own))
                if None in found:
                    gaps = [k for k, x in enumerate(found) if x is None]
                    missing.update([own[k] for k in gaps])
                    late.append((parts, len(parts), own, found, gaps))
                    parts.append(b"")
                else:
                    parts.append(b"".join(found))
                if len(missing) >= _TOGETHER:
                    settle()
        settle()
        return [b"".join(parts) for parts in out]

    def _encode_runs(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of runs, and of words in them, that aren't cached; a word by itself is a run of one word."""
        current, old = self.runs, self.runs.old
        new, parts, words = {}, {}, set()
        for r in missing:
            x = old.get(r)
            if x is not None:
                new[r] = x
            elif _letters(r):
                words.add(r)
            else:
                parts[r] = own = split_words(r)
                words.update([w for w in own if w not in current])
        words = [w for w in words if w not in new]
        new.update(zip(words, self.merge_all(words), strict=True))
        new.update([(r, b"".join([new[w] if w in new else current[w] for w in own])) for r, own in parts.items() if r not in new])
        return new

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_encoders: dict[bytes, WordBpe] = {}
common.kept["bpe"] = _encoders.clear


def encoder(tokenizer: bytes, lexicon: bytes | None = None, cache: int = 350_000) -> WordBpe:
    """One encoder per Python worker: its caches live on from task to task."""
    common.take_turn("bpe")
    key = hashlib.sha1(tokenizer + (lexicon or b"")).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordBpe(tokenizer, lexicon, cache)
    return _encoders[key]


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = 131_072) -> list[str]:
    """At most ``most`` of the most frequent letter runs, counted over every row.

    The least count that fits is read off the histogram of counts, so that no sort of the vocabulary and
    no top-k per partition is sent to the driver; words tied at the border stay out.
    """
    words = docs.select(F.explode(F.expr(f"regexp_extract_all(lower(`{text_col}`), '\\\\p{{L}}+', 0)")).alias("word"))
    counts = cut(words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1"))
    low, high = 2, None  # counts from ``low`` on are too many words, those from ``high`` on fit
    while True:
        # up to 1000 bins between both; the bin where the total passes the bound is split again
        top = counts.agg(F.max("n")).first()[0] if high is None else high
        if top is None:
            return []
        width = max(1, -(-(top + 1 - low) // 1000))
        bins = counts.where((F.col("n") >= low) & (F.col("n") <= top)).groupBy(F.expr(f"(n - {low}) div {width}").alias("bin")).agg(F.count("*").alias("words")).collect()
        total = 0 if high is None else counts.where(F.col("n") > top).count()
        border = None
        for k, words_in in sorted(((r["bin"], r["words"]) for r in bins), reverse=True):
            if total + words_in > most:
                border = k
                break
            total += words_in
        if border is None:
            least = low
        elif width > 1:
            low, high = low + border * width, min(top, low + (border + 1) * width - 1)
            continue
        else:
            least = low + border + 1
        return [r["word"] for r in counts.where(F.col("n") >= least).select("word").collect()]


def build_lexicon(tokenizer: bytes, words: list[str]) -> bytes:
    plain = WordBpe(tokenizer)
    return compile_lexicon({w.encode(): plain.merge(w) for w in words if w and not _NEWER.search(w) and _WORD.fullmatch(w)})


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = 131_072) -> DataFrame:
    """Per row: id, ids (array of int), decoded text."""
    return _mapped(docs, tokenizer_path, id_col, text_col, lexicon_words, "ids array<int>, decoded string", _arrays)


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = 131_072) -> DataFrame:
    """Per row: id, number of ids, SHA-256 of the ids and of the decoded text."""
    return _mapped(docs, tokenizer_path, id_col, text_col, lexicon_words, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)


def _arrays(bpe: WordBpe, texts: list) -> list[pa.Array]:
    ids = [bpe.encode(t) for t in texts]
    return [pa.array([np.frombuffer(x, "<u4").astype("i4") for x in ids], pa.list_(pa.int32())), pa.array([bpe.decode(x) for x in ids], pa.string())]


def _digests(bpe: WordBpe, texts: list) -> list[pa.Array]:
    n, a, b = [], [], []
    for t in texts:
        ids = bpe.encode(t)
        n.append(len(ids) // 4)
        a.append(hashlib.sha256(ids).hexdigest())
        b.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
    return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]


def _mapped(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, lexicon_words: int, columns: str, make) -> DataFrame:
    with open(tokenizer_path, "rb") as f:
        tokenizer = f.read()
    lexicon = build_lexicon(tokenizer, frequent_words(docs, text_col, lexicon_words)) if lexicon_words else None
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, lexicon))  # bounded by the vocabulary and lexicon_words
    rows = docs.select(F.col(id_col), F.col(text_col))
    names = [id_col, *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(*shared.value, cache=200_000)
        for batch, texts in pieces(batches, text_col, 8_000_000):
            yield pa.RecordBatch.from_arrays([batch.column(0), *make(bpe, texts)], names)

    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, {columns}")
