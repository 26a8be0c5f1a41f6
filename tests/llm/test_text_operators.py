"""BPE, packing, token counts, language ID, toxicity: brute force, round trips, held-out accuracy, odd rows."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from paneltide.llm import bpe, langid, packing, queries, token_counts, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", None, " \n\t", "don't I'LL we've '", "é é ΑΣ ΟΔΟΣ İ ǅ ﬁ", "a\x1cb\x85c​d", "<|endoftext|>x<|ENDOFTEXT|> <|startoftext|>", "日本語 ١٢٣ Ⅷ ²", "🙂🙂_a_b-c", "word " * 30_000]


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path()


@pytest.fixture(scope="module")
def reference(path):
    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and a column with a clashing name."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(ODD)] + [(3, ODD[3], None, None, None), (None, "the cat", None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def ids(reference, text):
    return reference.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(path, reference):
    rnd = random.Random(5)
    alphabet = "aÀé ŝ'sTΣß\n\t　 \x1f\x85\xa0²½Ⅳ٣日🙂<|>_—́‍e"
    texts = [t or "" for t in ODD] + ["".join(rnd.choice(alphabet) for _ in range(30)) for _ in range(2000)]
    raw = open(path, "rb").read()
    plain = bpe.WordBpe(raw)
    with_lexicon = bpe.WordBpe(raw, bpe.build_lexicon(raw, ["the", "cat", "cats", "éa", "word", "s"]))
    for t in texts:
        want = ids(reference, t)
        for own in (plain, with_lexicon):
            got = own.encode(t)
            assert np.frombuffer(got, "<u4").tolist() == want
            assert own.decode(got) == reference.decode(want, skip_special_tokens=False)


def test_every_code_point_encodes_as_in_the_library(path, reference):
    own = bpe.WordBpe(open(path, "rb").read())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3100 or 0xA640 <= c < 0xAC00 or 0xD7A4 <= c < 0x20000 or c % 64 == 0)]
    texts = [f"q{chr(c)}Q {chr(c)}{chr(c)}1" for c in points]
    for t, want in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.encode(t), "<u4").tolist() == want.ids, hex(ord(t[1]))


def test_long_words_merge_as_in_the_library(path, reference):
    own, rnd = bpe.WordBpe(open(path, "rb").read()), random.Random(3)
    for n in (64, 65, 66, 300, 20_000, 300_000):
        for alphabet in ("abcdefghijklmnopqrstuvwxyz", "ab", "aé日"):
            w = "".join(rnd.choices(alphabet, k=n))
            assert np.frombuffer(own.encode(w), "<u4").tolist() == ids(reference, w)


def test_transducer_is_exact_and_shares_suffixes():
    rnd = random.Random(1)
    words = {"".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 7))).encode() for _ in range(3000)}
    entries = {w: np.array([rnd.randrange(1 << 20) for _ in range(rnd.randint(1, 4))], "<u4").tobytes() for w in words}
    t = bpe.Transducer(bpe.compile_lexicon(entries))
    assert all(t.ids(w) == v for w, v in entries.items())
    assert sorted(t.rank(w) for w in words) == list(range(len(words)))
    for _ in range(2000):
        w = "".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 8))).encode()
        assert (t.rank(w) >= 0) == (w in words)
    assert len(t.final) < sum(map(len, words)) / 2
    assert bpe.Transducer(bpe.compile_lexicon({})).rank(b"a") == -1


def test_op5_digests(spark, path, reference):
    docs = queries.table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op5_bpe_round_trip(spark, SF).collect():
        want = ids(reference, texts[r.doc_id])
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(reference.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows_round_trip(odd, path, reference):
    got = bpe.encode_documents(odd.withColumnRenamed("source", "ids"), path).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        if r.doc_id is not None:
            assert list(r.ids) == ids(reference, ODD[r.doc_id])
    assert bpe.encode_documents(odd.limit(0), path).count() == 0


def test_frequent_words_are_counted_over_all_rows(spark):
    docs = spark.createDataFrame([(1, "The the cat"), (2, "cat the dog dog"), (3, None), (4, "once")], "doc_id long, text string")
    assert sorted(bpe.frequent_words(docs, most=1)) == ["the"]
    assert sorted(bpe.frequent_words(docs, most=3)) == ["cat", "dog", "the"]
    assert bpe.frequent_words(docs, most=2) == ["the"]  # two words tie at the border
    many = spark.range(3).selectExpr("id", "array_join(array_repeat(concat('w', char(97 + id)), cast(1500 * (id + 2) as int)), ' ') AS text")
    assert sorted(bpe.frequent_words(many, most=2)) == ["wb", "wc"]  # bins are split until the border fits
    assert bpe.frequent_words(docs.limit(0)) == []


def test_differencing_is_near_equal():
    rnd = np.random.default_rng(2)
    for n, k in ((0, 3), (1, 3), (5, 2), (400, 37)):
        sizes = rnd.integers(1, 4096, n)
        out = packing.differencing(sizes, k)
        assert len(out) == n and (not n or out.max() < k)
    sums = np.bincount(out, sizes)
    assert sums.max() - sums.min() < 200
    # the textbook instance: two-way differencing of 8 7 6 5 4 leaves a difference of 2
    assert sorted(np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])) == [14, 16]


def test_window_count_rises_until_all_fit():
    sizes = np.array([60, 60, 60])
    assert packing.deal(sizes, 100).max() == 2 and packing.deal(np.array([50, 50]), 100).max() == 0


def check_packing(rows, texts, reference, capacity):
    """Every id lies in one piece, crc and lengths are right, sequences are gapless and within capacity."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for doc, text in texts.items():
        want, at = [*ids(reference, text), 2], 0
        for r in sorted(docs.pop(doc), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(np.array(want[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want)
    assert not docs
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return sum(r.length for r in rows) / (capacity * len(sequences))


def test_differencing_of_very_many_short_texts():
    """Memory follows the items: 100,000 end ids in a group (empty texts) need 25 windows, not a table of items x windows."""
    out = packing.deal(np.ones(100_000, np.int64), 4096)
    assert out.max() == 24 and np.ptp(np.bincount(out)) <= 1


def test_op6_packs_everything(spark, reference):
    texts = {r.doc_id: r.text for r in queries.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    fill = check_packing(queries.op6_packing(spark, "/root/testdata/sf0.01").collect(), texts, reference, 4096)
    assert fill > 0.97


def test_packing_odd_rows(odd, path, reference):
    unique = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(packing.pack(unique, path, capacity=64, group_windows=8).collect(), dict(enumerate(ODD)), reference, 64)
    every = packing.pack(odd, path, capacity=64).groupBy().sum("length").first()[0]
    assert every == sum(len(ids(reference, r.text)) + 1 for r in odd.collect())
    assert packing.pack(odd.limit(0), path).count() == 0


def test_histogram_equals_brute_force(spark, odd, path, reference):
    lengths = sorted(len(ids(reference, r.text)) for r in odd.collect())
    h = token_counts.length_histogram(token_counts.encoded_lengths(odd, path), steps=4)
    for r in h.collect():
        n = r.length
        assert r.n_docs == lengths.count(n) and r.docs_over == sum(x > n for x in lengths) and r.tokens_within == sum(x for x in lengths if x <= n)
        assert r.truncated_tokens == sum(min(x, n) for x in lengths) and r.tokens_over == sum(x for x in lengths if x > n)
    assert {r.length for r in h.collect()} == set(lengths)
    for limit in (0, 3, 7, 1000, 10**9):
        assert token_counts.truncated_total(h, limit) == sum(min(x, limit) for x in lengths)
    assert token_counts.quantile(h, 0.5) == lengths[(len(lengths) + 1) // 2 - 1]
    assert token_counts.length_histogram(token_counts.encoded_lengths(odd.limit(0), path)).count() == 0


def test_op7_totals(spark, reference):
    lengths = [len(ids(reference, r.text)) for r in queries.table(spark, SF, "documents").collect()]
    rows = queries.op7_token_counts(spark, SF).collect()
    assert sum(r.n_docs for r in rows) == len(lengths) and sum(r.n_tokens for r in rows) == sum(lengths)


def brute_phrases(text, sample):
    """Greedy longest pieces of ``text`` that occur in ``sample``, both as codes; letters outside the samples never match."""
    sample = "".join(chr(100 + c) for c in sample)
    text = "".join(chr(100 + c) if c != langid.OTHER else "\x01" for c in text)
    n = at = 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at : at + k + 1] in sample:
            k += 1
        at, n = at + k, n + 1
    return n


def brute_predict(model, samples, text, max_chars=16_384):
    """Language, score and excess over the language's limit by the greedy parse in plain Python."""
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0, 1.0
    bits, phrases = [], []
    for lang in sorted(samples):
        seq = [c for t in samples[lang] for c in (langid.SPACE, *model.encode(t).tolist())][:max_chars]
        phrases.append(brute_phrases(model.encode(text).tolist(), seq))
        bits.append(phrases[-1] * np.log2(len(seq)))
    best = int(np.argmin(bits))
    x = len(model.encode(text))
    limit = float(model.limits[best])
    return sorted(samples)[best], 1 - bits[best] / min(b for i, b in enumerate(bits) if i != best), (phrases[best] - 1) / x - limit - 2 * (limit * (1 - limit) / x) ** 0.5


def test_cross_parsing_equals_brute_force():
    """Texts far longer than a stretch, phrases that run through several stretches, and one that is the whole sample."""
    samples = {"aa": ["the cat sat on the mat " * 40], "bb": ["der hund lief zum haus, ", "über alles"], "cc": ["今日は天気がいいから散歩しましょう" * 3]}
    model, rnd = langid.CrossParser(samples), random.Random(4)
    words = ["the cat ", "sat on", " the mat ", "der hund", "lief", " zum ", "haus", "über", "今日は", "天気", "q", "x1", " "]
    texts = ["".join(rnd.choice(words) for _ in range(n)) for n in (0, 1, 5, 40, 300, 900)] + [samples["aa"][0] * 3, "the cat sat on the mat " * 35, "q" * 2000, "今日は天気" * 150]
    coded = [model.encode(t) for t in texts]
    seqs = [[c for t in samples[k] for c in (langid.SPACE, *model.encode(t).tolist())] for k in sorted(samples)]
    assert model.phrases(coded).tolist() == [[brute_phrases(x.tolist(), seq) for seq in seqs] for x in coded]
    assert model.predict(["今日は散歩"])[0] == ["cc"]


def test_long_labelled_rows_are_learnt(spark):
    """A language that has long rows only, and samples of very different sizes."""
    rnd = random.Random(7)
    fr, en = ("le", "la", "maison", "des", "chien", "pour", "dans"), ("the", "of", "house", "dog", "for", "within", "and")
    rows = [(i, " ".join(rnd.choice(fr) for _ in range(6000)), "fr", None, None) for i in range(8)] + [(100 + i, " ".join(rnd.choice(en) for _ in range(40)), "en", None, None) for i in range(8)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, langid.train(docs)).collect()}
    assert got == {r[0]: r[2] for r in rows}


def test_op9_equals_brute_force(spark):
    """The query against the parse in plain Python, texts over 512 characters among them."""
    docs = queries.table(spark, SF, "documents").where("doc_id % 10 < 3")  # a small fixture, as the plain parse is slow
    held = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    model = langid.train(docs, exclude=held)
    texts = {r.doc_id: r.text for r in docs.collect()}
    samples = langid.samples_of(docs, exclude=held)
    assert max(map(len, texts.values())) > 2048
    for r in langid.identify_held_out(docs).collect():
        lang, score, _ = brute_predict(model, samples, texts[r.doc_id])
        assert r.lang_pred == lang and r.score == pytest.approx(score)


def test_short_clean_documents_stay(spark):
    """All held-out rows of a few words stay; letters at random and foreign scripts go."""
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    rnd = random.Random(8)
    short = [(10_000 + r.doc_id, " ".join(r.text.split()[:n]), None, None, None) for r in docs.limit(150).collect() for n in (1, 3, 6)]
    short = [r for r in short if any(map(str.isalpha, r[1]))]
    noise = [(-1, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300)), None, None, None), (-2, "今日は天気がいいから散歩しましょう", None, None, None), (-3, "12 34", None, None, None), (-4, None, None, None, None)]
    mixed = docs.unionByName(spark.createDataFrame(short + noise, DOCS))
    kept = {r.doc_id for r in langid.keep_identified(mixed).collect()}
    assert not kept & {r[0] for r in noise} and len([r for r in short if r[0] not in kept]) <= 0.01 * len(short)


def test_what_follows_a_common_head_is_learnt(spark):
    """199 documents of one language begin with 8300 characters of another language's licence; text of their own words alone is known and stays."""
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    english = " ".join(r.text for r in docs.where("lang = 'en' and length(text) > 3000").orderBy("doc_id").limit(3).collect())[:8300]
    rnd = random.Random(12)
    vocabulary = ["".join(rnd.choice("aeiouqxzkvw") for _ in range(rnd.randint(3, 8))) for _ in range(400)]
    own = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    rows = [(10**6 + i, english + " " + own(900), "xx", None, None) for i in range(199)]
    alone = [(2 * 10**6 + i, own(300), None, None, None) for i in range(20)]
    mixed = docs.unionByName(spark.createDataFrame(rows + alone, DOCS))
    model = langid.train(mixed)
    assert {r.lang_pred for r in langid.identify(spark.createDataFrame(alone, DOCS), model).collect()} == {"xx"}
    kept = {r.doc_id for r in langid.keep_identified(mixed).collect()}
    assert {r[0] for r in rows + alone} <= kept


@pytest.mark.parametrize("words", [5_000, 20_000])
def test_dense_scripts_stay_and_noise_goes(spark, words):
    """Whether a document is clean is known from how it was made: a script without spaces, words of 1 to 3 of its letters."""
    rnd = random.Random(words)
    letters = [chr(0x4E00 + i) for i in range(120)]
    vocabulary = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 3))) for _ in range(words)]
    clean = lambda n: "".join(rnd.choice(vocabulary) for _ in range(n))
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(10**6 + i, clean(800), "zz", None, None) for i in range(80)] + [(2 * 10**6 + i, clean(n), None, None, None) for n in (3, 10, 40, 500) for i in range(n, n + 10)]
    rows = [(d + k * 1000, *r) for k, (d, *r) in enumerate(rows)]
    noise = [(-1 - i, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)), None, None, None) for i, n in enumerate((150, 300, 1000, 5000))]
    mixed = docs.unionByName(spark.createDataFrame(rows + noise, DOCS))
    kept = {r.doc_id for r in langid.keep_identified(mixed).collect()}
    assert {r[0] for r in rows} <= kept and not kept & {r[0] for r in noise}


def test_roughness_has_no_step_in_length():
    """The limit falls slowly as texts get longer, and never below the language's own."""
    model = langid.CrossParser({"en": ["the cat sat on the mat and the dog ran"]})
    model.limits = np.array([0.6])
    slack = [model.predict(["q" * n])[2][0] - (n - 1) / n for n in range(5, 400)]
    assert all(a < b < -0.6 for a, b in zip(slack, slack[1:])) and max(b - a for a, b in zip(slack, slack[1:])) < 0.05


def test_characters_beyond_the_basic_plane():
    model = langid.CrossParser({"aa": ["the cat"], "bb": ["der hund"]})
    assert model.predict([None, "\U000e0101 \U000f0000", "\U00020000"])[0] == ["und", "und", "aa"]  # a variation selector and a private one are no letters


def test_op9_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.lang for r in queries.table(spark, sf, "documents").select("doc_id", "lang").collect()}
    rows = queries.op9_language_id(spark, sf).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.99 and all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark, odd):
    got = langid.identify_held_out(odd).collect()
    assert len(got) == len(ODD) + 2
    by = {r.doc_id: r for r in got}
    assert by[0].lang_pred == by[1].lang_pred == by[2].lang_pred == "und" and by[1].score == 0
    none = odd.selectExpr("doc_id", "text", "cast(null as string) AS lang", "source", "n_chars")
    assert {r.lang_pred for r in langid.identify_held_out(none).collect()} == {"und"}
    assert langid.keep_identified(odd.limit(0)).count() == 0
    assert langid.keep_identified(odd).columns == odd.columns
    clash = langid.identify(odd.withColumnRenamed("source", "lang_pred"), langid.CrossParser({"en": ["the cat"]}))
    assert clash.columns.count("lang_pred") == 1


def test_op8_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in queries.table(spark, sf, "labels").collect()}
    rows = queries.op8_toxicity(spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in rows)
    caught = [r.predicted for r in held if truth[r.doc_id]]
    clean = [r.predicted for r in held if not truth[r.doc_id]]
    assert sum(caught) >= 129 and np.mean(clean) < 0.01


NEUTRAL = [f"{a} {t} {b}" for a, b in (("the group of", "met today"), ("many", "live in the city"), ("a talk with", "about history")) for g in toxicity.IDENTITY_TERMS for t in g]


def logit(model, text):
    return np.log(model.score(text) / (1 - model.score(text)))


def test_swaps_are_regularised():
    rnd = random.Random(6)
    filler = [f"w{i}x" for i in range(40)]
    text = lambda *extra: " ".join([*rnd.sample(filler, 8), *extra])
    # the label goes with an insult, and the group's name mostly appears beside insults
    rows = [(text("muslims", "scum"), 1) for _ in range(80)] + [(text("scum"), 1) for _ in range(30)] + [(text(), 0) for _ in range(150)] + [(text("muslims"), 0) for _ in range(6)]
    gap = {}
    for penalty in (0.0, 50.0):
        m = toxicity.fit([t for t, _ in rows], [y for _, y in rows], penalty=penalty)
        gap[penalty] = abs(logit(m, "muslims walk") - logit(m, "christians walk"))
        assert m.score("you scum") > 0.7 and (penalty == 0 or m.score("muslims walk home") < 0.5)
    assert gap[50.0] < 0.5 * gap[0.0]


def test_every_labelled_text_has_twins():
    assert toxicity.mention(0) == ("women", "men") and toxicity.swapped(["jews", "sang"], 3) == ["atheists", "sang"]
    assert {toxicity.mention(t)[0] for t in range(200)} == set(toxicity._TWINS)
    assert all(toxicity._TWINS[a][0] == toxicity._TWINS[b][0] and a != b for a, b in map(toxicity.mention, range(200)))


def test_the_querys_own_model_is_regularised(spark):
    """Swaps move it less than a model without the penalty, on every identity term; neutral mentions stay clean."""
    sf = "/root/testdata/sf0.1"
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    held = "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"
    model, free = (toxicity.train(docs, labels, exclude=held, penalty=p) for p in (5.0, 0.0))
    assert set(toxicity._TWINS) <= set(model.weights) | set(free.weights)
    moved = {id(m): [abs(logit(m, f"they say {g[i]} walk") - logit(m, f"they say {g[i - 1]} walk")) for g in toxicity.IDENTITY_TERMS for i in range(len(g))] for m in (model, free)}
    assert np.mean(moved[id(model)]) < 0.05 * np.mean(moved[id(free)]) and max(moved[id(model)]) < 0.1
    assert max(model.score(t) for t in NEUTRAL) < 0.2


def brute_score(model, text):
    """The logistic of the bias and of the weights of the text's distinct words and stems."""
    return 1 / (1 + np.exp(-(model.bias + sum(model.weights.get(f, 0.0) for f in toxicity.features(text)))))


def test_op8_equals_brute_force(spark):
    docs, labels = queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels")
    model = toxicity.train(docs, labels, exclude="crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op8_toxicity(spark, SF).collect():
        assert r.score == pytest.approx(brute_score(model, texts[r.doc_id]))


def test_long_and_repeated_labelled_rows_are_learnt(spark):
    rows = [(i, "scum " + f"w{i} " * 30_000, None, None, None) for i in range(9)] * 2 + [(10 + i, "kind " + f"v{i} " * 30_000, None, None, None) for i in range(9)]
    labels = spark.createDataFrame([(i, 1, int(i < 9)) for i in [*range(9), *range(10, 19)]], "doc_id long, quality int, toxic int")
    model = toxicity.train(spark.createDataFrame(rows, DOCS), labels, max_total=1_000_000)
    assert model.score("scum") > 0.5 > model.score("kind")


def test_toxicity_odd_rows(spark, odd):
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (4, 0, 0), (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score_held_out(odd, labels).collect()
    assert len(got) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in got)
    nothing = toxicity.score_held_out(odd, labels.limit(0)).collect()
    assert {r.predicted for r in nothing} == {0}
    assert toxicity.keep_civil(odd, labels).columns == odd.columns and toxicity.keep_civil(odd.limit(0), labels).count() == 0
    assert toxicity.score(odd.withColumnRenamed("n_chars", "score"), toxicity.fit([], [])).columns.count("score") == 1
    assert list(itertools.islice(toxicity.features(None), 1)) == []


def test_caches_are_bounded_by_bytes():
    """20,000 runs of 1,000 letters, and as many of 100, keep little; what they are encoded to doesn't change."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    model = bpe.WordBpe(open(path, "rb").read(), cache=5_000)
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(n)) for n in [1000] * 500 + [100] * 20_000 + [5] * 20_000]
    for t in texts:
        model.encode(t)
    for cache in (model.words, model.runs):
        assert all(len(k) <= 128 for k in [*cache, *cache.old]) and sum(len(k) + len(v) for c in (cache, cache.old) for k, v in c.items()) <= 2 * 256 * 5_000
    reference = Tokenizer.from_file(path)
    for t in [*texts[:5], *texts[600:640], *texts[-40:]]:
        assert np.frombuffer(model.encode(t), "<u4").tolist() == reference.encode(t, add_special_tokens=False).ids


def test_equal_pieces_of_a_document_are_spread(spark):
    """A document of one word, over and over: its pieces go to many groups of windows."""
    docs = spark.createDataFrame([(1, "the " * 60_000, "en", "s", 1), (2, "a b c", "en", "s", 1)], DOCS)
    rows = packing.pack(docs, queries.tokenizer_path(), capacity=64, group_windows=8).collect()
    tokens = sum(r.length for r in rows)
    assert len({r.sequence_id >> 32 for r in rows}) >= 0.8 * tokens / (8 * 64)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id >> 32, []).append(r)
    assert max(map(len, by.values())) < 40


def test_texts_encoded_together_are_as_one_by_one(path, reference, monkeypatch):
    """Odd texts, contractions, symbols, long words, runs of several words, words met before and not; also with caches and groups of a few words."""
    rnd = random.Random(8)
    alphabet = "abcdeéß日²7'.,-!sm <|\n\x1f\x85\u0558"
    texts = [*ODD, "don't x'sy ''s !'s 's a' abc, abc. é! 7. .7 a7 ª", "ab" * 200 + " " + "é" * 40, "<|endoftext|> a"] + ["".join(rnd.choices(alphabet, k=60)) for _ in range(3000)]
    raw = open(path, "rb").read()
    want = [ids(reference, t) for t in texts]
    for together, cache in ((100_000, 350_000), (7, 350_000), (50, 20)):
        monkeypatch.setattr(bpe, "_TOGETHER", together)
        own = bpe.WordBpe(raw, cache=cache)
        for _ in range(2):
            assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_all(texts)] == want
        assert own.encode_all([]) == [] and own.encode_all([None, ""]) == [b"", b""]


def test_words_of_a_batch_are_merged_together(path, monkeypatch):
    """Packing's slices merge new words in columns; one by one each costs several times as much."""
    own, rnd, alone = bpe.WordBpe(open(path, "rb").read()), random.Random(9), []
    merge = own.merge
    monkeypatch.setattr(own, "merge", lambda w: alone.append(w) or merge(w))
    texts = [" ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) + rnd.choice(["", ",", "."]) for _ in range(200)) for _ in range(100)]
    got = own.encode_all(texts)
    assert len(alone) < 100
    assert got == [own.encode(t) for t in texts]
