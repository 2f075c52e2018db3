import bisect
import collections
import hashlib
import json
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchlake.llm import alignment, divergence, line_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def total(rows):
    return collections.Counter(tuple(r) for r in rows)


# ---- line dedup -------------------------------------------------------------------
def lines_truth(rows):
    """Per (doc_id, text): n_lines, n_dropped and the text that stays."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    first = {k: min(v, key=lambda i: (i is None, i or 0)) for k, v in holders.items() if len(v) > 1}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if first.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def check_lines(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = lines_truth(rows)
    got = line_dedup.dedup(df.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert total(got) == total(want)
    hashed = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in want]
    assert total(line_dedup.report(df).collect()) == total(hashed)
    return want


def test_lines_of_the_documents(docs):
    assert sum(d for _, _, d, _ in check_lines(docs)) > 100


def test_line_edges(spark, odd, empty):
    check_lines(odd)
    clash = odd.withColumns({c: F.lit("mine") for c in ("lost", "th", "h", "t", "i", "rest", "n_lines", "again", "segment")})
    got = line_dedup.dedup(clash)
    assert got.columns == [c for c in clash.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert {(r.lost, r.th, r.rest) for r in got.collect()} == {("mine",) * 3}
    assert line_dedup.report(empty).count() == 0 and line_dedup.dedup(empty).count() == 0
    rows = [
        (3, "  Same LINE here\t\nown\n\x0bsame line here\r"), (2, "same line here\nsame line here"), (9, "SAME line here"),
        (9, "nine chars\n123456789"), (4, "123456789\nÄÖÜäöüßéèà"), (5, " ÄÖÜäöüßéèà\r\nÄöÜäöüßéèà"), (None, "same line here\nno id line"),
        (None, "no id line!\nno id line"), (6, "ÄÖÜäöüßéè"), (7, "ÄÖÜäöüßéè"), (8, "a b same line  "), (10, "a b same line"),
        (11, "x" * 300_000), (12, "X" * 300_000), (13, "zzzzzzzzzz\n" * 40_000), (13, "zzzzzzzzzz"), (14, "zzzzzzzzzz\n" * 3),
    ]
    check_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_filters_lose_no_repeat(spark, docs, monkeypatch):
    """Small segments, and a folded filter so full that it reports wrongly."""
    monkeypatch.setattr(line_dedup, "KEYS", 64)
    monkeypatch.setattr(line_dedup, "FOLDED", 12)
    monkeypatch.setattr(line_dedup, "HELD", 50)
    check_lines(docs)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=60), max_size=6), st.integers(4, 12))
def test_twice_holds_every_repeat(parts, width):
    segment = line_dedup.Segment(12)
    seen = collections.Counter()
    for part in parts + parts[:1]:
        u = np.unique(np.array(part, np.uint64))
        segment.add(u, np.zeros(len(u), bool))
        seen.update(u.tolist())
    found = line_dedup.Suspects(np.packbits(segment.folded(width), bitorder="little"), 0, width)
    again = np.array([h for h, n in seen.items() if n > 1], np.uint64)
    assert found.reports(again).all()


def test_suspects_are_few(spark):
    """With room in the filters, hardly any line that occurs once is shuffled."""
    rows = [(i, f"a line of its own {i}\nthe shared line {i // 2}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    hashes = line_dedup._hashes(df, "text").cache()
    suspects = line_dedup._suspects(df, "text", line_dedup._twice(hashes, hashes.count()))
    assert 20_000 <= suspects.count() < 20_400
    hashes.unpersist()


def test_layout_has_a_bound():
    for n in (0, 1, 10**5, 10**9, 10**12, 10**15):
        whole, segments, width = line_dedup.layout(n)
        assert segments + width <= line_dedup.FOLDED and segments <= whole and (1 << whole) * line_dedup.KEYS >= n


# ---- source divergence ----------------------------------------------------------------
def divergence_truth(rows, least=30, top=50):
    n, docs = collections.Counter(), collections.Counter()
    groups = set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        for t in terms:
            n[lang, source, t] += 1
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {g for g, _ in groups}:
        kept = sorted(t for (x, t), k in docs.items() if x == lang and k >= least)
        sources = sorted(s for x, s in groups if x == lang)
        count = {s: [n[lang, s, t] for t in kept] for s in sources}
        whole = [sum(count[s][k] for s in sources) for k in range(len(kept))]
        p_of = lambda c: [1 + 10**9 * (x + 5) // (sum(c) + 5 * len(kept)) for x in c]
        p, q = {s: p_of(c) for s, c in count.items()}, p_of(whole)
        for s in sources:
            pairs = [(x, sum(abs(a - b) for a, b in zip(p[s], p[x]))) for x in sources if x != s]
            terms = [(t, a - b) for t, a, b, c in zip(kept, p[s], q, count[s]) if c and a > b]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(found[:most], 1)]
    return out


def check_audit(df, **more):
    rows = [(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()]
    want = divergence_truth(rows, **more)
    got = divergence.audit(df, **more)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert total(got.collect()) == total(want)
    return want


def test_audit_of_the_documents(docs):
    assert {part for _, _, part, *_ in check_audit(docs)} == {"pair", "term"}


def test_audit_in_small_tiles(spark, docs, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 3)
    monkeypatch.setattr(divergence, "TERMS", 40)
    monkeypatch.setattr(divergence, "HELD", 500)
    check_audit(docs, least=5, top=3)


def test_audit_edges(spark, odd, empty):
    assert divergence.audit(empty).count() == 0
    check_audit(odd)  # no kept terms: distances 0
    check_audit(odd, least=1)
    rows = [("Ünï-code ABC abc aBc x9y", "en", "a"), ("abc", "en", None), (None, "en", "b"), ("", None, "c"), ("İ ǅ z", None, "d"),
            ("abc z ä ä", "en", "a"), ("z \x85 z\xa0z", "en", "b"), ("1 2 3", "xx", "only")]
    check_audit(spark.createDataFrame(rows * 2, "text string, lang string, source string"), least=1, top=2)


def test_shares_of_huge_counts(spark):
    rows = [(0, 0, 0), (0, 0, 7), (9 * 10**14, 9 * 10**14, 3), (123_456_789_012, 10**15, 10**9), (1, 10**9, 1)]
    got = spark.createDataFrame(rows, "c bigint, n bigint, v bigint").select("*", divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    for r in got.collect():
        assert r.p == (1 + 10**9 * (r.c + 5) // (r.n + 5 * r.v) if r.v else 0)


# ---- alignment --------------------------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.default_file(alignment.A_FILE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.default_file(alignment.B_FILE))


def whole_text(tokenizers, text):
    """(ids, bytes) of both tokenizers over a whole text, by the libraries."""
    a, b = tokenizers
    letters = alignment.byte_letters()
    if not text:
        return None
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
    ]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    return ids_a, bytes_a, ids_b, bytes_b


def alignment_truth(tokenizers, rows, rule="end"):
    per, pairs = [], collections.Counter()
    for i, text in rows:
        got = whole_text(tokenizers, text)
        if got is None:
            per.append((i, 0, 0, 0, [], ""))
            continue
        ids_a, bytes_a, ids_b, bytes_b = got
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        in_group = [collections.defaultdict(list), collections.defaultdict(list)]
        for ids, ends, members in ((ids_a, ends_a, in_group[0]), (ids_b, ends_b, in_group[1])):
            for k, e in zip(ids, ends):
                members[bisect.bisect_left(cuts, e)].append(k)
        groups, links = [], []
        for a, b in ((in_group[0][k], in_group[1][k]) for k in range(len(cuts))):
            groups.append(",".join(map(str, a)) + "|" + ",".join(map(str, b)))
            links += [(x, y) for x in a for y in b] if rule == "slice" else []
        if rule == "end":
            at = dict(zip(ends_b, ids_b))
            links = [(x, at[e]) for x, e in zip(ids_a, ends_a) if e in at]
        pairs.update(links)
        per.append((i, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = collections.Counter()
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    return [
        (i, a, b, g, len(links), sum(pairs[x] == most[x[1]] for x in links), sum(pairs[x] for x in links), sha)
        for i, a, b, g, links, sha in per
    ]


@pytest.fixture(scope="module")
def aligner():
    with open(alignment.default_file(alignment.A_FILE), encoding="utf-8") as f, open(alignment.default_file(alignment.B_FILE), "rb") as g:
        return alignment.Aligner(f.read(), g.read())


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("abtheinr .,'s1\n\t\r   éß中\U0001f600▁\x00\x1c\xa0 <|>"), max_size=50))
def test_stretches_align_as_whole_texts(tokenizers, aligner, text):
    got, want = aligner(text), whole_text(tokenizers, text)
    assert (got is None) == (want is None)
    if got is not None:
        pairs = [g.split("|") for g in got[0].split(";")]
        assert [int(x) for a, _ in pairs for x in a.split(",")] == want[0]
        assert [int(x) for _, b in pairs for x in b.split(",")] == want[2]
        assert got[1:3] == (len(want[0]), len(want[2]))


def test_both_engines_of_a_give_the_same(tokenizers, docs):
    with open(alignment.default_file(alignment.A_FILE), encoding="utf-8") as f:
        a_json = f.read()
    assert alignment.merges_by_id(json.loads(a_json))
    with open(alignment.default_file(alignment.B_FILE), "rb") as f:
        fast = alignment.Aligner(a_json, f.read())
    slow = fast._merged(a_json)
    for r in docs.limit(60).collect():
        assert fast.ids_a(" " + r.text) == slow(" " + r.text) == tokenizers[0].encode(" " + r.text, add_special_tokens=False).ids


def test_special_tokens_are_text(tokenizers, aligner):
    got = aligner("x <|endoftext|> </s> y")
    assert got is not None and "50256" not in re.split("[,;|]", got[0])


def test_alignment_when_a_task_holds_several_partitions(spark, tokenizers):
    rows = [(i, f"word{i % 7} and filler{i % 5}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(80)
    assert total(alignment.report(df, sent=0).collect()) == total(alignment_truth(tokenizers, rows))


def test_alignment_of_the_documents(docs, tokenizers):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = total(alignment_truth(tokenizers, rows))
    assert total(alignment.report(docs).collect()) == want
    # most pairs joined by shuffle, the frequent ones sent
    assert total(alignment.report(docs, sent=100).collect()) == want
    assert total(alignment.report(docs, sent=0).collect()) == want


def test_generations_give_the_same(docs, tokenizers, monkeypatch, aligner):
    monkeypatch.setattr(alignment, "KEPT", 20)
    for r in docs.limit(30).collect():
        want = whole_text(tokenizers, r.text)
        got = aligner(r.text)
        assert got[1:3] == (len(want[0]), len(want[2]))


def test_all_pairs_of_a_slice(spark, tokenizers):
    rows = [(1, "unbelievable internationalization 12345678"), (2, "naïve 中文字 test"), (3, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = alignment.aligned(df, rule="slice").collect()
    want = {i: n for i, _, _, _, n, *_ in alignment_truth(tokenizers, rows, "slice")}
    assert {r.doc_id: r.n_links for r in out} == want


def test_alignment_edges(spark, odd, empty, tokenizers):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert total(alignment.report(odd).collect()) == total(alignment_truth(tokenizers, rows))
    assert alignment.report(empty).count() == 0 and alignment.report(empty, sent=0).count() == 0
    rows = [(1, None), (2, ""), (3, "a▁b c"), (4, "  two  spaces "), (None, "same words"), (None, "same words"), (5, "w" * 50_000), (6, " "), (7, "\n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = total(alignment.report(df).collect())
    assert got == total(alignment_truth(tokenizers, rows))
    zero = {r[0]: r for r in got}
    assert zero[1][1:] == zero[2][1:] == zero[3][1:] == (0, 0, 0, 0, 0, 0, "")
