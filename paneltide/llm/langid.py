"""Language identification by cross-parsing entropy (operator 9).

A suffix automaton per language is built from a bounded sample of labelled text. A text is parsed greedily
into the longest pieces that occur in a language's sample; phrases times the logarithm of the sample's size
estimate the cross entropy, so samples of different sizes compare, and the language of the least estimate
wins. All languages and many stretches of text are parsed in step by array operations; a stretch takes up the
phrase that is open where the one before it ends, so the result is that of one parse of the whole text.
Automata are kept as one sparse table of edges, in proportion to the samples, whatever the alphabet.

Defined results: a text that is null or has no letter is ``und`` with score 0; very long texts are parsed
whole; ties go to the language that sorts first; repeated rows are each judged (a sampled id counts once,
with its least text); with no labelled text at all every row is ``und``; an empty table gives an empty
result; columns of the output's names are replaced, any others stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from .common import crc_mod, pieces, take_turn, unused

STRETCH = 512  # characters parsed in step; no bound on phrases
OTHER, SPACE = 0, 1  # codes of letters outside the samples, and of runs of anything else


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of one sequence; state 0 is the start, and no edge leads back to it."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        cur = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return go


def edge_table(automata: list[list[dict[int, int]]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(base, owner, target, starts): state s goes by code c to target[base[s] + c] if owner[base[s] + c] is s.

    States of all automata are numbered through; edges of all states interleave in one table without gaps to
    speak of, states of many edges placed first.
    """
    states, starts = [], []
    for go in automata:
        shift = len(states)
        starts.append(shift)
        states += [{c: t + shift for c, t in edges.items() if c != OTHER} for edges in go]
    taken, base, at = bytearray(size), [0] * len(states), {}
    taken[:] = b"\1" * size  # places below ``size`` stay free of edges, so that no base is negative
    owner, target = [-1] * size, [0] * size
    for s in sorted((s for s, edges in enumerate(states) if edges), key=lambda s: -len(states[s])):
        codes = sorted(states[s])
        place = at.get(len(codes), size)
        while True:
            place = taken.find(0, place)
            if place < 0:
                place = len(taken)
            if place + size >= len(taken):
                grown = max(len(taken), 2 * size)
                taken.extend(bytes(grown))
                owner.extend([-1] * grown)
                target.extend([0] * grown)
            b = place - codes[0]
            if not any(taken[b + c] for c in codes[1:]):
                break
            place += 1
        at[len(codes)] = place + 1
        base[s] = b
        for c in codes:
            taken[b + c], owner[b + c], target[b + c] = 1, s, states[s][c]
    end = max(base, default=0) + size + 1
    return np.array(base, np.int32), np.array(owner[:end], np.int32), np.array(target[:end], np.int32), starts


class CrossParser:
    """Languages, the code of every character, and all automata as one table of edges."""

    def __init__(self, samples: dict[str, list[str]], max_chars: int = 16_384):
        self.languages = sorted(samples)
        letters = sorted({x for texts in samples.values() for t in texts for x in t.lower() if x.isalpha()})
        self.size = len(letters) + 2
        self.codes = np.fromiter((OTHER if chr(i).isalpha() else SPACE for i in range(0x110000)), np.int32, 0x110000)
        self.codes[[ord(x) for x in letters]] = np.arange(2, self.size)
        automata, lengths = [], []
        for lang in self.languages:
            seq: list[int] = []
            for t in samples[lang]:
                if len(seq) >= max_chars:
                    break
                seq += [SPACE, *self.encode(t).tolist()]
            automata.append(suffix_automaton(seq[:max_chars]))
            lengths.append(len(seq[:max_chars]))
        self.base, self.owner, self.target, starts = edge_table(automata, self.size)
        self.starts = np.array(starts, np.int32)
        #: bits that one phrase stands for: a place in the sample
        self.bits = np.log2(np.maximum(lengths, 2)) if lengths else np.empty(0)
        # first edges of each language, the start itself where there is none
        self.first = np.repeat(self.starts[:, None], self.size, axis=1).astype(np.int32)
        for k, go in enumerate(automata):
            for c, t in go[0].items():
                if c != OTHER:
                    self.first[k, c] = starts[k] + t
        self.first = self.first.ravel()
        #: roughness (further phrases per character) up to which a language explains a long text
        self.limits = np.full(len(self.languages), 1.0)

    def fit_limits(self, held: dict[str, list[str]], quantile: float = 0.9, least_chars: int = 256) -> None:
        """Limits halfway between what unseen text of each language needs and a phrase per character; without such text a language takes the most lenient limit of the others."""
        known = {}
        for lang in self.languages:
            coded = [x for x in map(self.encode, held.get(lang, [])) if len(x) >= least_chars]
            if coded:
                own = self.phrases(coded)[:, self.languages.index(lang)]
                known[lang] = (1 + np.quantile((own - 1) / [len(x) for x in coded], quantile)) / 2
        self.limits = np.array([known.get(lang, max(known.values(), default=1.0)) for lang in self.languages])

    def encode(self, text: str) -> np.ndarray:
        c = self.codes[np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")]
        return c[(c != SPACE) | (np.concatenate([[OTHER], c[:-1]]) != SPACE)]

    def step(self, state: np.ndarray, lang: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state, whether a phrase begins at this character)."""
        place = self.base[state] + code
        hit = self.owner[place] == state
        return np.where(hit, self.target[place], self.first[lang * self.size + code]), ~hit | (state == self.starts[lang])

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text in each language."""
        langs = len(self.languages)
        out = np.zeros((len(coded), langs), np.int64)
        spans = [(i, a, min(STRETCH, len(x) - a)) for i, x in enumerate(coded) for a in range(0, len(x), STRETCH)]
        if not spans or not langs:
            return out
        flat = np.concatenate(coded)
        begin = np.cumsum([0, *(len(x) for x in coded)])
        text, offset, length = (np.array(c, np.int64) for c in zip(*spans, strict=True))
        offset += begin[text]
        order = np.argsort(-length, kind="stable")  # those still running are always the first
        live = np.searchsorted(-length[order], -np.arange(length.max()), side="left")
        every = np.arange(langs)[:, None]
        state = np.repeat(self.starts[:, None], len(spans), axis=1)
        count = np.zeros(state.shape, np.int64)
        for t, k in enumerate(live.tolist()):
            own = order[:k]
            if k == len(spans):
                own = slice(None)
                state, began = self.step(state, every, flat[offset + t][None, :])
                count += began
            else:
                now, began = self.step(state[:, own], every, flat[offset[own] + t][None, :])
                state[:, own] = now
                count[:, own] += began
        # a stretch was parsed from the start state; parse it from where the one before it ends until both parses meet
        follows = np.flatnonzero(text[1:] == text[:-1]) + 1
        lang, span = np.repeat(np.arange(langs), len(follows)), np.tile(follows, langs)
        old, new = self.starts[lang], state[lang, span - 1]
        while len(span):
            apart = old != new
            lang, span, old, new = lang[apart], span[apart], old[apart], new[apart]
            more = np.zeros(len(span), np.int64)
            at, t = np.arange(len(span)), 0
            while len(at):
                code = flat[offset[span[at]] + t]
                a, x = self.step(old[at], lang[at], code)
                b, y = self.step(new[at], lang[at], code)
                more[at] += y.astype(np.int64) - x
                old[at], new[at] = a, b
                t += 1
                at = at[(a != b) & (t < length[span[at]])]
            count[lang, span] += more
            state[lang, span] = new
            # those that never met change how the next stretch begins
            on = (old != new) & (span + 1 < len(text))
            on[on] = text[span[on] + 1] == text[span[on]]
            lang, span, old, new = lang[on], span[on] + 1, old[on], new[on]
        np.add.at(out, text, count.T)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Languages, scores (share of bits saved against the next best), and by how much further phrases per character exceed the language's limit, plus two deviations of a text of that length."""
        spoken = [any(map(str.isalpha, t or "")) for t in texts]
        coded = [self.encode(t) if s else np.empty(0, np.int32) for t, s in zip(texts, spoken, strict=True)]
        counts = self.phrases(coded)
        langs, scores, rough = [], [], []
        for n, s, x in zip(counts, spoken, coded, strict=True):
            if not s or not self.languages:
                langs.append("und")
                scores.append(0.0)
                rough.append(1.0)
                continue
            bits = n * self.bits
            best = int(bits.argmin())
            rest = np.delete(bits, best)
            langs.append(self.languages[best])
            scores.append(float(1 - bits[best] / rest.min()) if len(rest) else 1.0)
            limit = self.limits[best]
            rough.append(float((n[best] - 1) / len(x) - limit - 2 * np.sqrt(limit * (1 - limit) / len(x))))
        return langs, scores, rough


def slices_of(docs: DataFrame, per_language: int = 64, size: int = 1024, per_text: int = 8, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", exclude: str = "false") -> dict[str, list[list[str]]]:
    """Per language the ``per_language`` labelled ids of least hash, each as up to ``per_text`` slices of ``size`` characters.

    Slices are spread over the whole text, its end included, and begin at a place that the id's hash picks, so
    that what all texts begin with doesn't fill the sample. No text is too long or too short to be sampled. Ids
    are chosen first, so texts aren't sorted or moved.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (F.length(text_col) > 0) & ~F.expr(exclude))
    order = W.partitionBy("lang").orderBy("h", "id")
    chosen = (
        labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(id_col).alias("h"))
        .withColumn("r", F.dense_rank().over(order)).where(F.col("r") <= per_language).select("lang", "id").distinct()
    )
    ids = sorted({r["id"] for r in chosen.collect()})
    n = F.least(F.lit(per_text), F.ceil(F.length(text_col) / size)).cast("int")
    begin = lambda i: F.when(n > 1, F.floor(i * (F.length(text_col) - size) / F.greatest(n - 1, F.lit(1)))).otherwise(0).cast("int") + 1
    cut_up = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col(text_col), begin(i), F.lit(size)))
    rows = (
        labelled.where(F.col(id_col).isin(ids)).groupBy(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"))
        .agg(F.min(cut_up).alias("slices")).withColumn("h", F.xxhash64("id")).collect() if ids else []
    )
    out: dict[str, list[list[str]]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"], r["id"])):
        first = r["h"] % len(r["slices"])
        out.setdefault(r["lang"], []).append(r["slices"][first:] + r["slices"][:first])
    return out


def samples_of(docs: DataFrame, per_language: int = 64, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", exclude: str = "false") -> dict[str, list[str]]:
    """What languages are learnt from: of each sampled text but every fourth a slice, then a second one, and so on."""
    return {lang: in_turn(learnt(texts)) for lang, texts in slices_of(docs, per_language, id_col=id_col, text_col=text_col, lang_col=lang_col, exclude=exclude).items()}


def learnt(texts: list[list[str]]) -> list[list[str]]:
    return [t for k, t in enumerate(texts) if k % 4 != 3]


def in_turn(texts: list[list[str]]) -> list[str]:
    return [t[j] for j in range(max(map(len, texts), default=0)) for t in texts if j < len(t)]


def train(docs: DataFrame, per_language: int = 64, max_chars: int = 16_384, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", exclude: str = "false") -> CrossParser:
    """Fit on a bounded sample: ``max_chars`` characters of each language's slices; every fourth text is kept to fit the language's limit."""
    sliced = slices_of(docs, per_language, id_col=id_col, text_col=text_col, lang_col=lang_col, exclude=exclude)
    model = CrossParser({lang: in_turn(learnt(texts)) for lang, texts in sliced.items()}, max_chars)
    model.fit_limits({lang: in_turn(texts[3::4]) for lang, texts in sliced.items()})
    return model


def identify(docs: DataFrame, model: CrossParser, text_col: str = "text", out: Sequence[str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with more columns: predicted language, score (share of bits saved against the next best) and, if three are named, how far the text is beyond its language's limit.

    Columns of ``docs`` that already have these names are replaced.
    """
    docs = docs.drop(*out)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: edges of languages x max_chars characters, and a code per character
    kinds = (T.StringType(), T.DoubleType(), T.DoubleType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(out, kinds, strict=False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("langid")
        for batch, texts in pieces(batches, text_col, 2_000_000):
            made = zip(shared.value.predict(texts), (pa.string(), pa.float64(), pa.float64()), out, strict=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, k) for v, k, _ in made)], [*batch.schema.names, *out])

    return docs.mapInArrow(run, schema)


def identify_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learnt from the rows that aren't held out."""
    held = f"{crc_mod('doc_id', 4)} = 2"
    return identify(docs.select("doc_id", F.expr(held).alias("held_out"), "text"), train(docs, exclude=held)).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that some language explains; the columns stay as they are.

    Texts without letters go, and those that the best language can only parse into far shorter pieces than text
    of that language outside its sample: beyond halfway to single characters, and by more than two deviations for
    the text's length. So dense scripts and short texts, of which little can be said, stay; close seconds don't
    matter.
    """
    lang, score, excess = (unused(docs, n) for n in ("lang_pred", "lang_score", "lang_excess"))
    found = identify(docs, train(docs), out=(lang, score, excess))
    return found.where((F.col(lang) != "und") & (F.col(excess) <= 0)).drop(lang, score, excess)
