import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from matchlake.llm import class_lm, common, langid, quality, toxicity

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    pos = y.sum()
    return (order[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


# ---- language model --------------------------------------------------------------
def base_scores(rows):
    counts = collections.Counter()
    toks = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) + ["</s>"] for _, t in rows]
    for (i, _), tk in zip(rows, toks):
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            counts.update(tk)
    n, v = sum(counts.values()), len(counts)
    return [
        (len(tk), sum(t in counts for t in tk), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tk)) for tk in toks
    ]


def test_base_score_is_exact_and_the_model_beats_it(docs):
    got = {r.doc_id: r for r in class_lm.score(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for (i, _), (n, known, total, base) in zip(rows, base_scores(rows)):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_edges(odd, empty):
    got = class_lm.score(odd).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted((x[0], x[1], x[2], round(x[3], 6)) for x in base_scores(rows))
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert class_lm.score(empty).count() == 0


def test_base_score_when_a_task_holds_several_partitions(spark, monkeypatch):
    """Words beyond the table are joined to their rows by number: rows of
    partitions that share a task must not share one."""
    monkeypatch.setattr(class_lm, "TABLE", 40)
    rows = [(i, " ".join(f"Word{(i * k) % 83} w{i % 29}" for k in range(1 + i % 7))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(80)
    got = {r.doc_id: r for r in class_lm.score(docs).collect()}
    assert len(got) == len(rows)
    for (i, _), (n, known, total, base) in zip(rows, base_scores(rows)):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(0)
    true = rng.integers(0, 3, 30)
    link = np.array([[0.1, 8, 0.1], [0.1, 0.1, 8], [8, 0.1, 0.1]])
    big = rng.poisson(link[true][:, true]).astype(float)

    def likelihood(of, k):
        m = np.zeros((30, k))
        m[np.arange(30), of] = 1
        t = m.T @ big @ m
        return class_lm._f(t).sum() - class_lm._f(t.sum(0)).sum() - class_lm._f(t.sum(1)).sum()

    of = class_lm.exchange(big, classes=4, fixed=29)
    start = np.arange(30) % 3
    assert likelihood(of, 4) > likelihood(start, 4)
    assert (of == 3).sum() == 1 and of[29] == 3
    # words of one true class end up together
    for c in range(3):
        mine = of[:29][true[:29] == c]
        assert np.bincount(mine).max() >= 0.8 * len(mine)


def likelihood_of(big, of, k):
    m = np.zeros((len(big), k))
    m[np.arange(len(big)), of] = 1
    return class_lm.likelihood(m.T @ big @ m)


def test_gains_of_words_equal_the_likelihood_of_each_move():
    rng = np.random.default_rng(3)
    size, k = 24, 5
    big = rng.poisson(rng.gamma(0.4, 2.0, (size, size))).astype(float)
    of = rng.integers(0, k, size)
    member = np.zeros((size, k))
    member[np.arange(size), of] = 1
    own = np.diag(big).copy()
    after, before = big @ member, big.T @ member
    after[np.arange(size), of] -= own
    before[np.arange(size), of] -= own
    gain = class_lm.gains(member.T @ big @ member, of, after, before, own)
    for u in range(size):
        for b in range(k):
            to = of.copy()
            to[u] = b
            move = likelihood_of(big, to, k) - likelihood_of(big, of, k)
            assert math.isclose(gain[u, b] - gain[u, of[u]], move, rel_tol=1e-6, abs_tol=1e-6)


def test_gains_of_small_and_large_counts_agree_with_the_likelihood():
    rng = np.random.default_rng(5)
    size, k = 20, 4
    # counts on both sides of those that are looked up
    big = rng.poisson(rng.gamma(0.4, 3.0 * class_lm.STEPS, (size, size))).astype(float)
    of = rng.integers(0, k, size)
    member = np.eye(k)[of]
    own = np.diag(big).copy()
    after, before = big @ member, big.T @ member
    after[np.arange(size), of] -= own
    before[np.arange(size), of] -= own
    assert (after > class_lm.STEPS).any() and ((after > 0) & (after <= class_lm.STEPS)).any()
    table = member.T @ big @ member
    steps = class_lm.steps_of(table), class_lm.steps_of(table.T)
    gain = class_lm.gains(table, of, after, before, own, steps)
    for u in range(size):
        for b in range(k):
            to = of.copy()
            to[u] = b
            move = likelihood_of(big, to, k) - likelihood_of(big, of, k)
            assert math.isclose(gain[u, b] - gain[u, of[u]], move, rel_tol=1e-6, abs_tol=1e-6)


def test_a_round_reads_the_bigrams_of_its_half_only(docs):
    texts = docs.where(common.fold("doc_id", 7) != 2).select("text")
    h, n, g, _ = class_lm.frequent(class_lm.count_words(texts).where("ending >= 0"))
    cut = int((n >= class_lm.OFTEN).sum())
    units = class_lm.Units(h[:cut], g[:cut])
    halves = {}
    for row in class_lm.bigrams(texts, units).collect():
        words = np.concatenate([np.frombuffer(row[side], np.int64) // units.size for side in ("after", "before")])
        inside = (words >= units.hot) & (words < units.end)
        assert (words[inside] % 2 == row.half).all() and inside.all() == inside.any() == (row.half >= 0)
        halves.setdefault(row.half, set()).update(words.tolist())
    assert set(halves) == {-1, 0, 1}
    assert halves[0] | halves[1] == set(range(units.hot, units.end))


def plain_words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def test_class_scores_equal_a_plain_computation(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    texts = docs.where(common.fold("doc_id", 7) != 2).select("text")
    m = class_lm.Model(class_lm.count_words(texts), texts)
    counts = collections.Counter(w for t in train for w in plain_words(t))
    vocab = sorted(counts | collections.Counter(w for _, t in rows for w in plain_words(t)))
    looked_up = next(class_lm._words(pa.array([" ".join(vocab)])))
    unit = dict(zip(vocab, m.units.of(looked_up, class_lm.Lookup(m.units.hashes)).tolist()))
    # all words from the threshold on are exchanged by themselves
    assert {w for w in counts if unit[w] < m.units.end} == {w for w in counts if counts[w] >= class_lm.OFTEN}
    assert m.exchanged == sum(n for n in counts.values() if n >= class_lm.OFTEN)
    end = int(m.of[m.units.end])
    cls = {w: int(m.of[u]) for w, u in unit.items()}
    assert end not in cls.values()

    pairs, size = collections.Counter(), collections.Counter()
    kinds = collections.Counter(cls[w] for w in counts) + collections.Counter([end])
    for t in train:
        seq = [cls[w] for w in plain_words(t)] + [end]
        size.update(seq)
        pairs.update(zip([end] + seq[:-1], seq))
    total, out = sum(size.values()), collections.Counter()
    for (a, _), n in pairs.items():
        out[a] += n

    def plain(text):
        got, a = 0.0, end
        for b in [cls[w] for w in plain_words(text)] + [end]:
            share = (size[b] + 1) / (total + class_lm.CLASSES)
            got += math.log10((pairs[a, b] + class_lm.BETA * share) / (out[a] + class_lm.BETA))
            a = b
        for w in plain_words(text):
            got += math.log10((counts[w] + 1) / (size[cls[w]] + kinds[cls[w]] + 1))
        return got + math.log10((len(train) + 1) / (size[end] + kinds[end] + 1))

    got = {r.doc_id: r.score for r in class_lm.score(docs).collect()}
    for i, t in rows:
        assert math.isclose(got[i], plain(t), rel_tol=1e-9, abs_tol=1e-6)


def test_words_exchanged_in_tasks_raise_the_likelihood(docs):
    texts = docs.where(common.fold("doc_id", 7) != 2).select("text")
    words = class_lm.count_words(texts)
    h, n, g, _ = class_lm.frequent(words.where("ending >= 0"))
    cut = int((n >= class_lm.OFTEN).sum())
    units = class_lm.Units(h[:cut], g[:cut])
    pairs = class_lm.bigrams(texts, units).cache()
    coarse = units.coarse()
    by_unit = class_lm.tally(pairs, units, coarse, class_lm.UNITS)
    assert by_unit.sum() == n.sum() + words.where("ending < 0").first().n
    start = class_lm.exchange(by_unit)[coarse]
    of, table = class_lm.exchange_words(pairs, units, start)
    assert class_lm.likelihood(table) > class_lm.likelihood(class_lm.tally(pairs, units, start, class_lm.CLASSES))
    assert np.array_equal(table, class_lm.tally(pairs, units, of, class_lm.CLASSES))
    assert np.array_equal(of[: units.hot], start[: units.hot]) and (of != start).any()
    # whole lists of the exchanged words in one row, both sides, added up
    where, sums = {}, {"after": collections.Counter(), "before": collections.Counter()}
    for k, row in enumerate(pairs.collect()):
        for side in sums:
            for key, times in zip(np.frombuffer(row[side], np.int64).tolist(), np.frombuffer(row[f"{side}_n"], np.int64).tolist()):
                word, other = divmod(key, units.size)
                sums[side][(word, other) if side == "after" else (other, word)] += times
                if units.hot <= word < units.end:
                    assert where.setdefault(word, k) == k
    own = {p: t for p, t in sums["after"].items() if units.hot <= p[1] < units.end}
    assert own == dict(sums["before"]) and set(where) == set(range(units.hot, units.end))
    pairs.unpersist()


def test_bigrams_of_a_single_part_are_in_the_order_of_words(docs):
    # one task: nothing is added up, and the lists come as they were counted
    texts = docs.where(common.fold("doc_id", 7) != 2).select("text").coalesce(1)
    h, n, g, _ = class_lm.frequent(class_lm.count_words(texts).where("ending >= 0"))
    cut = int((n >= class_lm.OFTEN).sum())
    units = class_lm.Units(h[:cut], g[:cut])
    pairs = class_lm.bigrams(texts, units).cache()
    for row in pairs.collect():
        for side in ("after", "before"):
            assert (np.diff(np.frombuffer(row[side], np.int64)) > 0).all()
    coarse = units.coarse()
    start = class_lm.exchange(class_lm.tally(pairs, units, coarse, class_lm.UNITS))[coarse]
    of, table = class_lm.exchange_words(pairs, units, start, rounds=2)
    assert np.array_equal(table, class_lm.tally(pairs, units, of, class_lm.CLASSES)) and (of != start).any()
    pairs.unpersist()


# ---- language ID -------------------------------------------------------------------
def test_languages_on_held_out_rows(docs):
    got = {r.doc_id: r for r in langid.predictions(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i, r in got.items() if r.held_out and lang[i] is not None]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert sum(got[i].lang_pred == lang[i] for i in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_case_marks_and_repeats_do_not_decide_the_language(docs):
    ways = langid.Compressors(langid.training_passages(docs))
    rows = docs.where("text is not null and lang is not null and n_chars between 200 and 4000").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    for change in (str.upper, lambda t: t.replace(" ", "!! 77 "), lambda t: t + " xyz" * 400):
        assert sum(ways.predict(change(r.text))[0] == r.lang for r in held) / len(held) > 0.95


def test_equal_sizes_go_to_the_language_of_more_documents(spark):
    rows = [(k, "one two three four" if k < 60 else "uno dos tres cuatro", "zz" if k < 60 else "aa") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    passages = langid.training_passages(docs)
    assert [name for name, _ in passages] == ["zz", "aa"]
    assert langid.Compressors(passages).predict("q")[0] == "zz"


def test_language_edges(odd, empty):
    got = langid.predictions(odd).collect()
    assert len(got) == odd.count()
    text = collections.Counter(t is None or not re.search(r"[^\W\d_]", t) for t in (r.text for r in odd.collect()))
    assert sum(r.lang_pred == "und" for r in got) == text[True]
    assert {r.lang_pred for r in got} <= {"en", "fr", "und"}
    assert langid.predictions(empty).count() == 0


# ---- toxicity -----------------------------------------------------------------------
def test_toxicity_on_held_out_labels(spark):
    # 3000 labelled rows: words of the smaller languages have to occur a few times
    docs, labels = common.documents(spark, "/root/testdata/sf0.1"), common.labels(spark, "/root/testdata/sf0.1")
    got = {r.doc_id: r for r in toxicity.report(docs, labels).collect()}
    held = [(got[r.doc_id].score, r.toxic, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    score, y, p = (np.array(x) for x in zip(*held))
    assert auc(score, y) > 0.94
    assert ((p == 0) & (y == 0)).sum() / (y == 0).sum() > 0.98
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(1)
    y = rng.random(20000) < 0.2
    sens, spec = [0.8, 0.7, 0.6, 0.75], [0.98, 0.97, 0.99, 0.96]
    v = np.stack([np.where(y, rng.random(20000) < a, rng.random(20000) > b) for a, b in zip(sens, spec)], axis=1)
    v = np.concatenate([v, v[:, :1] ^ (rng.random((20000, 1)) < 0.02)], axis=1)  # a near copy of the first voter
    code, n = np.unique(v @ (1 << np.arange(5)), return_counts=True)
    m = toxicity.LabelModel((code[:, None] >> np.arange(5)) & 1, np.full(len(code), -1), n.astype(float))
    assert any({0, 4} <= set(g) for g in m.groups)
    assert np.abs(m.sensitivity[:4] - sens).max() < 0.08
    assert np.abs(m.specificity[:4] - spec).max() < 0.04
    assert abs(m.prior - 0.2) < 0.05


@pytest.mark.parametrize("text, want", [
    ("a calm day in the garden", set()),
    ("they called him a moron", {"intellect", "named_insult", "dense_insults"}),
    ("you are pathetic, pathetic scum", {
        "worth", "disgust", "two_insults", "three_insults", "two_themes", "repeated_insult", "insult_at_you", "named_insult",
        "insult_pair", "dense_insults"}),
    ("what an 1d10t and m0ron, st00pid stuuupid thing", {"disguised", "stretched"}),
    ("du bist ein dummkopf", {"german", "insult_at_you", "named_insult", "dense_insults"}),
    ("I will strangle this guitar!!!", {"threat", "exclaiming"}),
    ("THIS IS A VERY LOUD TEXT ABOUT NOTHING", {"shouting"}),
    ("", set()),
])
def test_voters_do_not_need_labels(text, want):
    none = toxicity.Mined(*[np.zeros(0, np.uint64)] * 3)
    # rows beside it: no vote may cross from one row to another
    [(w, shape)] = toxicity._read(pa.array(["you such a", text, "moron moron you"]))
    votes = toxicity.Voting(none)(w, shape)[0]
    assert {toxicity.VOTERS[j] for j in np.flatnonzero(votes[1])} == want
    assert len(toxicity.UNLABELLED) == 20


def test_only_copies_leave_the_mining_sample():
    low = list(range(4))
    words = [low + list(range(10, 50)), low + list(range(10, 49)), low + list(range(100, 140)), low + list(range(10, 50))]
    t = pa.table({"word": pa.array(words, pa.list_(pa.int64())), "label": [1, 1, 1, 0], "doc_id": [0, 1, 2, 3]})
    assert toxicity.without_copies(t).column("doc_id").to_pylist() == [0, 2, 3]


def test_votes_of_the_sample_equal_those_of_its_texts():
    texts = ["you idiot moron", "", "Worth  alphabet losers losers", "QUITE LOUD words!!! of alphabets and m0ron", "plain"]
    batch = pa.record_batch([range(5), texts, [1, 0, 1, 1, 0]], ["doc_id", "text", "label"])
    words = [w for t in texts for w in t.split()]
    [all_words] = toxicity._words(pa.array([" ".join(words)]))
    mined = toxicity.Mined(*(np.unique(h)[::2] for h in (all_words.hash, all_words.more["begin"], all_words.more["ending"])))
    sample = pa.Table.from_batches(toxicity._sample_features(iter([batch])))
    votes, rows, feats = toxicity._sample_votes(sample, mined)
    [(w, shape)] = toxicity._read(batch.column("text"))
    want, want_rows, want_feats = toxicity.Voting(mined)(w, shape)
    assert votes.astype(bool).tolist() == want.tolist() and votes[:, len(toxicity.UNLABELLED) :].any()
    assert sorted(zip(rows.tolist(), feats.tolist())) == sorted(zip(want_rows.tolist(), want_feats.tolist()))


def test_toxicity_reads_the_documents_for_sample_and_combinations_only(spark, docs, labels):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = docs.select("doc_id", "text")
    toxicity.fit(rows.mapInArrow(count, rows.schema), labels)
    assert read.value == 2 * docs.count()


def test_toxicity_edges(odd, empty, some_labels, no_labels):
    for lab in (some_labels, no_labels):
        got = toxicity.report(odd, lab).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.report(empty, some_labels).count() == 0
    kept = toxicity.drop_toxic(odd, no_labels)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_samples_hold_all_features_of_long_documents():
    text = " ".join(f"{k}x{k}" for k in range(9000))
    batch = pa.record_batch([[1], [text], [1], [len(text)]], ["doc_id", "text", "label", "n_chars"])
    for kind in ("word", "begin", "ending"):
        got = pa.Table.from_batches(toxicity._sample_features(iter([batch]))).column(kind)[0].values.to_numpy()
        w = next(toxicity._words(batch.column("text")))
        every = w.hash if kind == "word" else w.more[kind]
        assert set(got.view(np.uint64).tolist()) == set(every.tolist())
    got = pa.Table.from_batches(quality._sample_features(iter([batch]))).column("words")[0].values.to_numpy()
    [(_, _, _, _, buckets)] = quality.features(batch.column("text"), quality._declared(batch))
    assert set(got.tolist()) == set(buckets.tolist()) and len(got) > 4096


# ---- quality ------------------------------------------------------------------------
def test_quality_on_held_out_labels(docs, labels):
    got = {r.doc_id: r for r in quality.report(docs, labels).collect()}
    held = [(got[r.doc_id].score, r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    score, y, p = (np.array(x) for x in zip(*held))
    assert auc(score, y) > 0.97
    assert (p == y).mean() > 0.93


def test_linear_time_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    size = quality.BUCKETS + len(quality.STATS) * (1 + quality.BINS)
    m = len(quality.STATS)
    fm = quality.Machine(np.zeros(m), np.ones(m), np.zeros((m, quality.BINS - 1)), 0.3,
                         rng.normal(size=size), rng.normal(size=(size, quality.RANK)))
    feat, value = rng.integers(0, size, 12), rng.normal(size=12)
    got = fm.logits(np.zeros(12, int), feat, value, 1)[0]
    want = 0.3 + (fm.weight[feat] * value).sum()
    for i in range(12):
        for j in range(i):
            want += fm.vectors[feat[i]] @ fm.vectors[feat[j]] * value[i] * value[j]
    assert got == pytest.approx(want)


def test_quality_edges(odd, empty, some_labels, no_labels):
    for lab in (some_labels, no_labels):
        got = quality.report(odd, lab).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.report(empty, some_labels).count() == 0
    assert quality.report(odd.drop("n_chars"), no_labels).count() == odd.count()
