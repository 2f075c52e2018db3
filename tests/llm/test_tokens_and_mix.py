import collections
import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import mixing, pieces

VOCABULARY = pieces.read_vocabulary(pieces.default_model())
CODEC = pieces.Codec(VOCABULARY)
SLOW = pieces.Codec(VOCABULARY)
SLOW.by_line, SLOW.split = False, None


def brute(text):
    """Best score over all segmentations, by a table over all substrings."""
    longest = max(map(len, CODEC.scores))
    best = [0.0] + [float("-inf")] * len(text)
    for e in range(1, len(text) + 1):
        best[e] = best[e - 1] + CODEC.unknown
        for b in range(max(0, e - longest), e):
            got = CODEC.scores.get(text[b:e])
            if got is not None:
                best[e] = max(best[e], best[b] + got[0])
    return best[-1]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from("abtheinr .,\n\t  éß中\U0001f600▁\x00"), max_size=60))
def test_round_trip_and_best_score(text):
    ids, score = CODEC.encode(text)
    assert CODEC.decode(ids) == text
    whole_ids, whole = SLOW.encode(text)
    assert score == pytest.approx(whole)
    if text and "▁" not in text:
        assert score == pytest.approx(brute("▁" + text.replace(" ", "▁")))
    assert CODEC.decode(whole_ids) == text


def test_the_library_decodes_the_same_text(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for r in docs.limit(40).collect():
        ids, score = CODEC.encode(r.text)
        assert sp.decode(ids.tolist()) == r.text
        own = sp.encode(r.text)
        assert score >= sum(CODEC.scores[sp.id_to_piece(i)][0] if not sp.is_byte(i) else CODEC.unknown for i in own) - 1e-6


def test_generations_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 3)
    c = pieces.Codec(VOCABULARY)
    text = " ".join(f"word{i % 7} and{i}" for i in range(60))
    assert c.encode(text)[0].tolist() == c.encode(text)[0].tolist() == CODEC.encode(text)[0].tolist()


def test_piece_edges(odd, empty):
    got = pieces.report(odd).collect()
    assert len(got) == odd.count() and all(r.exact for r in got)
    assert sum(r.ids_sha256 is None for r in got) == sum(r.text is None for r in odd.collect())
    assert pieces.report(empty).count() == 0
    back = pieces.decode(pieces.encode(odd.drop("ids"))).collect()
    assert all(r.decoded == r.text for r in back)


def test_pieces_of_the_documents(docs):
    got = {r.doc_id: r for r in pieces.report(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        assert got[r.doc_id].exact and got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


# ---- mixing -----------------------------------------------------------------------------
def target_truth(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = (budget - sum(out.values())) / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s] + 1e-9}
        if not over:
            out.update({s: level * w[s] for s in open_})
            break
        out.update({s: most * sizes[s] for s in over})
        open_ -= over
    return out


def test_fit_meets_the_best_reachable_sum():
    rng = np.random.default_rng(7)
    cases = [([4, 13], [2, 1], 15), ([6, 10, 15], [1, 1, 1], 14), ([0, 3], [5, 2], 4), ([7, 14, 21, 3], [40, 30, 9, 1], 500)]
    for _ in range(3000):
        n = int(rng.integers(1, 6))
        sizes = rng.choice(np.arange(0, 40), n, replace=False)
        counts = rng.integers(1, 9, n)
        cases.append((sizes, counts, int(rng.integers(0, (sizes * counts).sum() + 3))))
    for sizes, counts, budget in cases:
        sizes, counts = np.asarray(sizes), np.asarray(counts)
        sums = {0}
        for z, n in zip(sizes.tolist(), counts.tolist()):
            sums = {t + k * z for t in sums for k in range(n + 1)}
        took = mixing.fit_counts(sizes, counts, budget)
        assert ((took >= 0) & (took <= counts)).all()
        assert int((sizes * took).sum()) == max(t for t in sums if t <= budget), (sizes, counts, budget)


def test_fit_of_a_large_source():
    rng = np.random.default_rng(8)
    sizes, counts = np.arange(1, 4000), rng.integers(1, 2000, 3999)
    for budget in (123_456_789, int((sizes * counts).sum()) // 2):
        took = mixing.fit_counts(sizes, counts, budget)
        assert int((sizes * took).sum()) == budget and ((took >= 0) & (took <= counts)).all()
    few = mixing.fit_counts(np.array([40, 130]), np.array([3_000_000, 2_000_000]), 200_000_015)
    assert few @ [40, 130] == 200_000_010


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 3)), min_size=1, max_size=4, unique_by=lambda x: x[0]), st.integers(0, 80))
def test_knapsack_finds_the_nearest_sum(items, budget):
    s = np.array([a for a, _ in items])
    c = np.array([b for _, b in items])
    took = mixing._knapsack(s, c, budget)
    assert ((0 <= took) & (took <= c)).all()
    sums = {sum(a * b for a, b in zip(s, k)) for k in itertools.product(*(range(n + 1) for n in c))}
    assert (s * took).sum() == max(x for x in sums if x <= budget)


def check_mix(df):
    rows = df.collect()
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    totals = collections.Counter()
    for r in rows:
        totals[r.source] += size(r.text)
    want = target_truth(totals)
    got = mixing.mix(df).collect()
    assert sorted(r.size for r in got) == sorted(size(r.text) for r in rows)
    taken, biggest = collections.Counter(), collections.Counter()
    for r in got:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    return {s: (taken[s], want[s], biggest[s]) for s in want}


def test_mix_meets_its_targets(docs):
    for taken, target, _ in check_mix(docs).values():
        assert abs(taken - target) <= 10
    key = lambda rows: sorted((r.doc_id, r.taken) for r in rows)
    assert key(mixing.report(docs).collect()) == key(mixing.report(docs.repartition(5)).collect())


def test_one_hot_size_is_split_by_buckets(spark):
    df = spark.createDataFrame([(i, "a b c", "s") for i in range(5000)] + [(9000, "q " * 5000, "t")],
                               "doc_id bigint, text string, source string")
    for taken, target, biggest in check_mix(df).values():
        assert abs(taken - target) <= biggest


def test_mix_edges(odd, empty):
    for taken, target, biggest in check_mix(odd).values():
        assert abs(taken - target) <= biggest
    m = mixing.mixed(odd)
    assert m.columns == odd.columns
    words = collections.Counter()
    for r in mixing.mix(odd).collect():
        words[r.source] += r.taken
    again = collections.Counter()
    for r in m.collect():
        again[r.source] += len((r.text or "").split())
    assert +words == +again
    # documents without words stay once
    bare = lambda rows: sum(not (r.text or "").split() for r in rows)
    assert bare(m.collect()) == bare(odd.collect())
    assert mixing.report(empty).count() == 0 and mixing.mixed(empty).count() == 0
