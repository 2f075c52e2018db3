import collections
import hashlib
import re
import textwrap

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchlake.llm import exact_dedup, fingerprints, jaccard_join, licenses


# ---- fingerprints -----------------------------------------------------------------
def fps(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r.i: r for r in fingerprints.with_fingerprint(df, "text", "fp").select("i", "fp", fingerprints.as_text(F.col("fp")).alias("hex")).collect()}


def test_order_does_not_matter_but_counts_do(spark):
    got = fps(spark, ["a b\nc d\ne", "e\na b\nc d", "a b\nc d\ne\ne", "", None, "a b\nc d\nf"])
    assert got[0].hex == got[1].hex != got[2].hex
    assert got[3].hex == got[4].hex
    assert len({got[k].hex for k in (0, 2, 3, 5)}) == 4


def test_pieces_are_inserted_and_deleted(spark):
    df = spark.createDataFrame([("x y\nz", "p q", "z\np q\nx y")], "a string, b string, ab string")
    for c in ("a", "b", "ab"):
        df = fingerprints.with_fingerprint(df, c, f"f_{c}")
    r = df.select(
        (fingerprints.combine(F.col("f_a"), F.col("f_b")) == F.col("f_ab")).alias("added"),
        (fingerprints.combine(F.col("f_ab"), F.col("f_b"), -1) == F.col("f_a")).alias("removed"),
    ).first()
    assert r.added and r.removed


def test_lanes_hold_many_equal_pieces(spark):
    df = spark.createDataFrame([("0\n" * 40_000, "0\n" * 30_000 + "x y\n" * 100)], "a string, b string")
    for c in ("a", "b"):
        df = fingerprints.with_fingerprint(df, c, f"f_{c}")
    a, b = F.col("f_a"), F.col("f_b")
    r = df.select(
        fingerprints.likeness(a, b).alias("near"),
        (fingerprints.combine(fingerprints.combine(a, b), b, -1) == a).alias("back"),
    ).first()
    assert r.near > 0.99 and r.back


def test_edited_texts(docs):
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in fingerprints.fingerprint_report(docs).collect()}
    near = []
    for k, (i, t) in enumerate(rows):
        q = len(t) // 4
        edited = t[: len(t) - q] + rows[(k + 1) % len(rows)][1][:q]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].n_chars == len(t)
        near.append((got[i].near_edited, got[i].near_next))
    a, b = np.array(near).T
    assert a.mean() > 0.6 and b.mean() < 0.2 and ((0 <= a) & (a <= 1)).all()


def test_fingerprint_edges(spark, odd, empty):
    got = fingerprints.fingerprint_report(odd).collect()
    assert len(got) == odd.count()
    by = collections.defaultdict(set)
    for r, t in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars)), range(len(got))):
        by[(r.doc_id, r.n_chars)].add((r.fingerprint, r.edited_sha256))
    assert all(len(v) == 1 for v in by.values())
    assert fingerprints.fingerprint_report(empty).count() == 0
    one = fingerprints.fingerprint_report(spark.createDataFrame([(5, "abcdefgh")], "doc_id bigint, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0


# ---- exact dedup ---------------------------------------------------------------------
@settings(max_examples=40, deadline=None)
@given(st.sets(st.binary(min_size=32, max_size=32), max_size=400))
def test_slots_are_minimal_and_perfect(digests):
    words = exact_dedup._words(sorted(digests)) if digests else np.zeros((0, 4), "<u8")
    sizes, bits, slot = exact_dedup.build_slots(words)
    assert sorted(slot.tolist()) == list(range(len(words)))
    assert (exact_dedup.find_slots(words, sizes, bits) == slot).all()


def dedup_truth(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = collections.defaultdict(list)
    for (i, _), t in zip(rows, norm):
        groups[t].append(i)
    return [
        ((i is None, i or 0), (min((x for x in groups[t] if x is not None), default=None)), len(groups[t]),
         hashlib.sha256(t.encode()).hexdigest())
        for (i, _), t in zip(rows, norm)
    ]


def test_exact_dedup_edges(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = exact_dedup.decisions(odd).collect()
    mine = [((r.doc_id is None, r.doc_id or 0), r.keep_id, r.group_size, r.text_sha256) for r in got]
    assert sorted(mine, key=str) == sorted(dedup_truth(rows), key=str)
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in got)
    assert exact_dedup.decisions(empty).count() == 0 and exact_dedup.keep_first(empty).count() == 0


def test_only_full_digests_are_members(spark):
    a = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id bigint, text string")
    b = spark.createDataFrame([(i, f"text {i}") for i in range(2900, 6000)], "doc_id bigint, text string")
    dig = lambda d: d.select("doc_id", exact_dedup.digest(F.col("text")).alias("digest"))
    g = exact_dedup.groups(dig(a), dig(b)).collect()
    assert len(g) == 6000 and sum(r.group_size == 2 for r in g) == 100
    assert sorted(r.keep_id for r in g) == list(range(6000))


# ---- n-gram Jaccard join ----------------------------------------------------------------
def sets_of(text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def join_truth(rows):
    """(links, smallest id of the group) per row, by brute force."""
    s = [sets_of(t) for _, t in rows]
    holders = collections.defaultdict(list)
    links, up = collections.Counter(), list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in enumerate(s):
        near = collections.Counter(k for g in x for k in holders[g])
        for g in x:
            holders[g].append(i)
        for k, n in near.items():
            if n >= 0.8 * (len(x) + len(s[k]) - n):
                links[i] += 1
                links[k] += 1
                up[find(k)] = find(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [(d, links[i], low.get(find(i))) for i, (d, _) in enumerate(rows)]


def compare(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    want = sorted(join_truth(rows), key=key)
    got = sorted(((r.doc_id, r.n_links, r.class_id) for r in jaccard_join.join(df).collect()), key=key)
    assert got == want
    return got


def test_join_equals_brute_force(docs):
    got = compare(docs)
    assert sum(n for _, n, _ in got) > 0


def test_join_with_split_nodes_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 6)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):  # one large near-copy cluster
        w = list(base)
        w[(i * 7) % 120] = f"x{i}"
        rows.append((i, " ".join(w)))
    for i in range(60):  # texts that share a passage
        rows.append((100 + i, " ".join(base[:30] + [f"y{i}_{k}" for k in range(20)])))
    compare(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_join_edges(odd, empty):
    compare(odd)
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    with_words = [r.doc_id for r in kept.collect() if (r.text or "").strip()]
    assert sorted(x for x in with_words if x is not None) == [3, 4, 7, 9] and None in with_words
    assert jaccard_join.join(empty).count() == 0 and jaccard_join.keep_one(empty).count() == 0


def test_groups_are_told_apart_without_ids(spark):
    near = [f"n{i}" for i in range(60)]
    rows = [
        (None, "red green blue cyan pink grey"), (None, "one two three four five six"),  # unrelated, no ids
        (5, "sun moon star sky cloud rain"), (5, "oak elm ash fir yew bay"),  # unrelated, one id
        (None, " ".join(near)), (8, " ".join(near[:-1] + ["last"])), (7, " ".join(["first"] + near[1:])),  # one group
        (None, "same words here and there now"), (None, "same words here and there now"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    compare(df)
    got = sorted(((r.doc_id or 0, r.text) for r in jaccard_join.keep_one(df).collect()))
    assert got == sorted((i or 0, t) for i, t in [*rows[:4], rows[6], rows[7]])


# ---- licence scans ------------------------------------------------------------------------
def test_licence_lines_of_the_documents(docs):
    lines = {
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    }
    got = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        want = ",".join(sorted(k for k, v in lines.items() if v in r.text)) or None
        assert got[r.doc_id] == want


def test_changed_wordings(spark):
    apache = licenses.TEMPLATES["Apache-2.0"][1]
    texts = [
        "prose\n\n" + apache.replace("may not use", "cannot use").replace(" You may", "\nYou may") + "\n\nmore prose",
        "Permission to land is granted.\nNothing else.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert got[0].licenses == "Apache-2.0" and 0 < got[0].wording_changes <= 4
    assert got[1].licenses is None and got[1].n_candidates == 1
    assert got[2].licenses == "LGPL-3.0" and got[2].wording_changes == 0


def test_wrapped_wordings(spark):
    texts, want = [], []
    for name, k in (("MIT", 1), ("MPL-2.0", 0), ("BSD-3-Clause", 0), ("ISC", 0), ("GPL-3.0", 1)):
        for width in (40, 60, 76):
            body = textwrap.fill(licenses.TEMPLATES[name][k], width)
            texts += [body, "Some prose.\n\n" + textwrap.indent(body, " * ") + "\n\n" + "More prose here.\n" * 40]
            want += [(name, 0, 0), (name, 2, 0)]
    texts.append(textwrap.fill(licenses.TEMPLATES["MIT"][1], 76).replace("\nANY", "\n\nANY"))
    want.append(("MIT", 0, 0))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(licenses.scan(df).collect(), key=lambda r: r.doc_id)
    assert [(r.licenses, r.first_line, r.wording_changes) for r in got] == want


def test_every_notice_of_a_block(spark):
    lines = "\n".join(f"Copyright {k} all rights of licence {k}" for k in range(40))
    mit, isc = (textwrap.fill(licenses.TEMPLATES[k][-1], 70) for k in ("MIT", "ISC"))
    texts = [
        "Released under the MIT License.\nLicensed under CC BY 4.0.",
        "\n".join([lines, mit, lines, isc, lines, mit, lines]),
        # the second notice is left beside a better alignment that overlaps it
        "Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0. Licensed under CC BY-NC 4.0.",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(licenses.scan(df).collect(), key=lambda r: r.doc_id)
    assert [(r.n_confirmed, r.licenses) for r in got] == [
        (2, "CC-BY-4.0,MIT"), (3, "ISC,MIT"), (3, "CC-BY-4.0,CC-BY-NC-4.0,CC-BY-SA-4.0")
    ]


def notices(text):
    return licenses.Scanner(licenses.TEMPLATES).matches(text)


@pytest.mark.parametrize("text, want", [
    ("Released under the Apache License.", []), ("Released under the BSD License.", []),
    ("Released under the GPL License.", []), ("Released under the Company License.", []),
    ("Released under the MIT License.", ["MIT"]), ("Licensed under CC BY 3.0.", ["CC-BY-3.0"]),
    ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]), ("Licensed under the Apache License, Version 1.1.", []),
    ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
    ("Licensed under the GNU General Public License, version 2, or (at your option) any later version.", ["GPL-2.0-or-later"]),
    ("Licensed under the GNU Lesser General Public License, version 2.1", ["LGPL-2.1"]),
    ("Licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
    ("Licensed under the GNU General Public License, version 4.", []),
    ("SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]), ("SPDX-License-Identifier: Apache-1.1", []),
    (licenses.TEMPLATES["GPL-2.0-or-later"][1], ["GPL-2.0-or-later"]),
    (licenses.TEMPLATES["AGPL-3.0-or-later"][1], ["AGPL-3.0-or-later"]),
    (licenses.BSD_HEAD + licenses.BSD_WARRANTY, ["BSD-2-Clause"]),
    (licenses.BSD_HEAD.replace("met: ", "met: 1. ").replace("disclaimer. ", "disclaimer. 2. ") + licenses.BSD_WARRANTY, ["BSD-2-Clause"]),
    (licenses.TEMPLATES["BSD-3-Clause"][0].replace("the copyright holder nor", "Acme Inc. nor"), ["BSD-3-Clause"]),
    (licenses.BSD_HEAD + " All advertising materials must display an acknowledgement." + licenses.BSD_THIRD
     + licenses.BSD_WARRANTY, []),
    (licenses.TEMPLATES["X11"][0], ["X11"]), (licenses.TEMPLATES["MIT-0"][0], ["MIT-0"]), (licenses.TEMPLATES["0BSD"][0], ["0BSD"]),
])
def test_close_wordings_are_told_apart(text, want):
    assert [m[1] for m in notices(text)[1]] == want
    assert [m[1] for m in notices(f"Words before it.\n\n{textwrap.fill(text, 50)}\n\nWords behind it.")[1]] == want


def test_another_version_is_unknown():
    assert notices("Licensed under the Apache License, Version 1.1")[1:] == ([], 1)
    assert notices("The game was played as is, on the field.")[1:] == ([], 0)


def test_the_ranking_decides(monkeypatch):
    """Both templates' wordings are in the text; the one that saves more wins."""
    x11 = licenses.TEMPLATES["X11"][0]
    assert [m[1] for m in notices(x11)[1]] == ["X11"]
    ranked = licenses.Scanner.ranked
    monkeypatch.setattr(licenses.Scanner, "ranked", lambda *a: ranked(*a)[::-1])
    assert [m[1] for m in notices(x11)[1]] == ["MIT"]


def test_the_gate_loses_no_wording(docs, monkeypatch):
    """Every wording of every template in the middle of prose, with the gate
    and by brute force, where all templates are compared word by word."""
    prose = [r.text for r in docs.select("text").orderBy("doc_id").collect() if r.text and not licenses._cue.search(r.text)][:20]
    texts = []
    for name, wordings in sorted(licenses.TEMPLATES.items()):
        for k, w in enumerate([*wordings, f"SPDX-License-Identifier: {name}"]):
            before, behind = prose[len(texts) % 20], prose[(len(texts) + k + 1) % 20]
            texts.append((name, before + "\n" + textwrap.fill("Licensed " + w, 40 + k) + "\n" + behind))
    gated = licenses.Scanner(licenses.TEMPLATES)
    found = [gated.matches(t)[1] for _, t in texts]
    assert [[m[1] for m in got] for got in found] == [[name] for name, _ in texts]
    monkeypatch.setattr(licenses, "SAVED", -1e9)
    assert [gated.matches(t)[1] for _, t in texts] == found


def test_licence_edges(odd, empty):
    got = licenses.scan(odd).collect()
    assert len(got) == odd.count() and all(r.licenses is None for r in got)
    assert licenses.scan(empty).count() == 0
