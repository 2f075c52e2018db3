"""Toxicity by weak supervision.

Twenty voters look at a text's words and shape, never at labels: lists of
insults by theme and language, threats, insults that come in numbers, near each
other, near a second person or after a naming word, disguised and stretched
spellings made from the lists by rule, capitals and exclamation marks. Four
more look for words, word beginnings and word endings that are tied to toxic
texts in a bounded sample of labelled training documents: no list covers every
language. Each votes toxic or abstains.

A generative label model explains how often each combination of votes occurs
over all documents: a hidden label, a share of toxic texts, the accuracies of
the voters, and their correlations (voters that still depend on each other
given the label are modelled together, by the joint table of their votes). The
labels of the training fold are one more, noisy, voter. It is fitted by EM on
the table of combinations that occur; some hundreds do.

A logistic regression is then trained on the posterior labels of the sample,
with the votes and the tied words as features, and scores every whole text.

Null and empty texts have no words and get the score of a text without hits; an
empty table gives an empty one. Repeated rows each get a row, null ids too, and
ties a score alike.
Without labelled training rows the label model's own odds stand in for the
trained weights.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays, common, sampling

SAMPLE = 9_000  # labelled documents for mining and training, about
THRESHOLD = 0.3
MIN_DOCS, MIN_SHARE = 4, 0.005  # toxic sample documents a tied feature occurs in, at least
LEAST_LIFT = 2.0  # log odds of a tied feature, lower bound
SEED = 4

# Insults by theme or language, threats, and words around them.
THEMES = {
    "intellect": "idiot idiots moron morons stupid dumb imbecile retard fool",
    "worth": "loser losers worthless pathetic garbage trash clown coward liar",
    "disgust": "scum filth vermin disgusting pig freak creep ugly",
    "profane": "bastard jerk shut hate bitch asshole shit fuck",
    "german": "idioten dumm abschaum versager arschloch dummkopf",
    "french": "connard ordure crétin débile salaud",
    "spanish": "idiota estupido estúpido imbécil basura cabrón",
}
INSULTS = [w for words in THEMES.values() for w in words.split()]
THREATS = "kill murder strangle stab töten umbringen tuer matar".split()
SECOND_PERSON = "you your you're u ur du ihr dich dein tu te toi vous tú usted vos".split()
NAMING = "a an the such are is re what bist ein eine un une eres es".split()
DISGUISE = str.maketrans("aeiost", "431057")

UNLABELLED = [
    *THEMES, "threat", "two_insults", "three_insults", "two_themes", "repeated_insult", "insult_at_you", "named_insult",
    "insult_pair", "dense_insults", "disguised", "stretched", "shouting", "exclaiming",
]
TIED = ["tied_word", "two_tied_words", "tied_beginning", "tied_ending"]
VOTERS = UNLABELLED + TIED
DENSE = 0.02  # insults to words of a text
SHOUTED, LETTERS = 0.3, 20  # capitals to letters, and letters a text has at least
EXCLAIMED = 3
LABELLED = 5  # labelled documents of each kind that correlations are read from, at least
COPIES = 0.8  # Jaccard similarity of the words of two copies
BEGIN, ENDING = 5, 6

_byte = np.arange(256)
UPPER = (_byte >= 65) & (_byte <= 90)
SHAPES = [UPPER, UPPER | ((_byte >= 97) & (_byte <= 122)), _byte == ord("!")]
EXTRAS = {"begin": lambda p: p.prefix(BEGIN), "ending": lambda p: p.suffix(ENDING)}


def _hashes(words: list[str]) -> np.ndarray:
    return np.unique(np.array([arrays.hash_word(w, lower=True) for w in words], np.uint64))


class Known:
    """Membership of hashes in a sorted list, by a small bitmap first."""

    def __init__(self, sorted_hashes: np.ndarray, bits: int = 20):
        self.hashes, self.bits = sorted_hashes, np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[(sorted_hashes >> self.bits).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``h``, positions in the list) of the members."""
        maybe = np.flatnonzero(self.seen[(h >> self.bits).astype(np.int64)])
        if not len(maybe) or not len(self.hashes):
            return maybe[:0], maybe[:0]
        at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        hit = self.hashes[at] == h[maybe]
        return maybe[hit], at[hit]


def _distinct(row: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(row):
        return row, what
    pairs = np.unique(np.stack([row, what]), axis=1)
    return pairs[0], pairs[1]


@dataclass
class Mined:
    words: np.ndarray
    begins: np.ndarray
    endings: np.ndarray


def disguised(words: list[str]) -> list[str]:
    """Spellings with one letter, or all, replaced by look-alike digits."""
    every = [w.translate(DISGUISE) for w in words]
    one = [w[:i] + w[i].translate(DISGUISE) + w[i + 1 :] for w in words for i in range(len(w))]
    return sorted(set(every + one) - set(words))


def stretched(words: list[str]) -> list[str]:
    """Spellings with a vowel three to eight times."""
    return sorted({w[:i] + w[i] * n + w[i + 1 :] for w in words for i in range(len(w)) if w[i] in "aeiou" for n in range(3, 9)})


class Voting:
    """Votes and tied features of a group of rows."""

    def __init__(self, mined: Mined):
        themes = {int(_hashes([w])[0]): k for k, words in enumerate(THEMES.values()) for w in words.split()}
        self.insults = Known(_hashes(INSULTS))
        self.theme = np.array([themes[int(h)] for h in self.insults.hashes])
        self.you, self.naming = Known(_hashes(SECOND_PERSON)), Known(_hashes(NAMING))
        self.lists = [Known(_hashes(words)) for words in (THREATS, disguised(INSULTS), stretched(INSULTS))]
        self.kinds = [Known(mined.words), Known(mined.begins), Known(mined.endings)]
        self.sizes = [len(k.hashes) for k in self.kinds]

    def _at_you(self, w: arrays.Words, at: np.ndarray) -> np.ndarray:
        """Which of the insults have a second person within four words."""
        you = np.zeros(len(w.hash) + 8, bool)
        you[self.you.find(w.hash)[0] + 4] = True
        near = np.zeros(len(at), bool)
        for step in range(1, 9):
            if step != 4:
                near |= you[at + step]
        # a neighbour may belong to the row before or after: check by row
        for k in np.flatnonzero(near):
            lo, hi = max(0, at[k] - 3), min(len(w.hash), at[k] + 5)
            window = np.flatnonzero(you[lo + 4 : hi + 4]) + lo
            near[k] = bool((w.row[window] == w.row[at[k]]).any())
        return near

    def voted(self, w: arrays.Words, shape: np.ndarray) -> np.ndarray:
        """Votes, rows x UNLABELLED; ``shape``: bytes of SHAPES per row."""
        votes = {name: np.zeros(w.rows, bool) for name in UNLABELLED}
        at, which = self.insults.find(w.hash)
        row = w.row[at]
        hits = np.bincount(row, minlength=w.rows)
        for k, name in enumerate(THEMES):
            votes[name][row[self.theme[which] == k]] = True
        for name, known in zip(("threat", "disguised", "stretched"), self.lists):
            votes[name][w.row[known.find(w.hash)[0]]] = True
        votes["two_insults"], votes["three_insults"] = hits > 1, hits > 2
        votes["two_themes"] = np.bincount(_distinct(row, self.theme[which])[0], minlength=w.rows) > 1
        votes["repeated_insult"] = np.bincount(_distinct(row, which)[0], minlength=w.rows) < hits
        votes["insult_at_you"][row[self._at_you(w, at)]] = True
        names = np.zeros(len(w.hash) + 1, bool)
        names[self.naming.find(w.hash)[0] + 1] = True
        before = np.maximum(at - 1, 0)
        votes["named_insult"][row[names[at] & (w.row[before] == row)]] = True
        close = (np.diff(at) <= 2) & (np.diff(row) == 0)
        votes["insult_pair"][row[1:][close]] = True
        votes["dense_insults"] = (hits > 0) & (hits >= DENSE * w.per_row())
        upper, letters, bangs = shape.T
        votes["shouting"] = (letters >= LETTERS) & (upper >= SHOUTED * letters)
        votes["exclaiming"] = bangs >= EXCLAIMED
        return np.stack([votes[name] for name in UNLABELLED], axis=1)

    def __call__(self, w: arrays.Words, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(votes rows x VOTERS, rows of features, features)."""
        ties = np.zeros((w.rows, len(TIED)), bool)
        rows, feats, base = [], [], 0
        for kind, (known, h) in enumerate(zip(self.kinds, (w.hash, w.more["begin"], w.more["ending"]))):
            at, which = known.find(h)
            r, f = _distinct(w.row[at], which)
            n = np.bincount(r, minlength=w.rows)
            if kind == 0:
                ties[:, 0], ties[:, 1] = n > 0, n > 1
            else:
                ties[:, 1 + kind] = n > 0
            rows.append(r)
            feats.append(f + base)
            base += self.sizes[kind]
        votes = np.concatenate([self.voted(w, shape), ties], axis=1)
        return votes, np.concatenate(rows), np.concatenate(feats)


def _coded(votes: np.ndarray) -> np.ndarray:
    """A number for each row's combination of votes."""
    return (votes << np.arange(votes.shape[1])).sum(axis=1)


def _words(col) -> Iterator[arrays.Words]:
    return arrays.words(col, arrays.NOT_ALNUM, lower=True, extras=EXTRAS)


def _read(col) -> Iterator[tuple[arrays.Words, np.ndarray]]:
    """Words and shapes of groups of rows."""
    shape = arrays.class_counts(col, SHAPES)
    for w in _words(col):
        yield w, shape[w.lo : w.hi]


# ---- mining ------------------------------------------------------------------------
def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word, beginning and ending hashes of each sample document, and
    its votes that need no tied features."""
    none = np.zeros(0, np.uint64)
    voting, row = Voting(Mined(none, none, none)), 0
    for batch in batches:
        for w, shape in _read(batch.column("text")):
            cut = np.concatenate(([0], np.cumsum(w.per_row())))
            cols: list[list] = [[], [], []]
            for r in range(w.rows):
                for out, h in zip(cols, (w.hash, w.more["begin"], w.more["ending"])):
                    out.append(np.unique(h[cut[r] : cut[r + 1]]).view(np.int64))
            kind = pa.list_(pa.int64())
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(w.lo, w.rows), pa.array(np.arange(row, row + w.rows)),
                    batch.column("label").slice(w.lo, w.rows), pa.array(_coded(voting.voted(w, shape))),
                    *(pa.array(c, kind) for c in cols),
                ],
                ["doc_id", "row", "label", "votes", "word", "begin", "ending"],
            )
            row += w.rows


def without_copies(sample: pa.Table) -> pa.Table:
    """One of the sample documents that share ``COPIES`` of their words: copies
    of one toxic text are no evidence that its rare words are toxic. Copies are
    looked for among those of the same lowest word hashes and compared by all."""
    kept: dict[tuple, list[np.ndarray]] = {}
    stay = []
    for k, (words, label) in enumerate(zip(sample.column("word"), sample.column("label").to_pylist())):
        own = words.values.to_numpy()  # distinct, in order
        others = kept.setdefault((label, own[:4].tobytes()), [])
        for other in others:
            both = len(np.intersect1d(own, other, assume_unique=True))
            if both >= COPIES * (len(own) + len(other) - both):
                break
        else:
            others.append(own)
            stay.append(k)
    return sample.take(pa.array(stay, pa.int64()))


def mine(sample: pa.Table) -> Mined:
    """Features whose log odds towards toxic documents are surely large."""
    sample = without_copies(sample)
    y = sample.column("label").to_numpy().astype(bool)
    out = []
    for kind in ("word", "begin", "ending"):
        col = sample.column(kind).combine_chunks() if len(y) else pa.array([], pa.list_(pa.int64()))
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.list_(pa.int64()))
        off = col.offsets.to_numpy() if len(col) else np.zeros(1, np.int64)
        h = (col.values.to_numpy()[off[0] : off[-1]] if len(col) else np.zeros(0, np.int64)).view(np.uint64)
        toxic = np.repeat(y, np.diff(off))
        keys, n, bad = arrays.merge_counts(h, np.ones(len(h), np.int64), toxic.astype(np.int64))
        pos, neg = bad + 0.5, n - bad + 0.5
        lift = np.log(pos / max(y.sum(), 1)) - np.log(neg / max((~y).sum(), 1))
        sure = lift - 1.0 * np.sqrt(1 / pos + 1 / neg)
        out.append(keys[(bad >= max(MIN_DOCS, MIN_SHARE * y.sum())) & (sure >= LEAST_LIFT)])
    return Mined(*out)


# ---- label model -------------------------------------------------------------------
class LabelModel:
    """EM over counts of vote combinations.

    ``votes``: combinations x voters (0 or 1); ``label``: -1 none, 0, 1;
    ``count``: how many documents have the combination.
    """

    def __init__(self, votes: np.ndarray, label: np.ndarray, count: np.ndarray, rounds: int = 60):
        self.m = votes.shape[1]
        self.groups = [[j] for j in range(self.m)]
        q = self._start(votes, label, count)
        # voters of one list agree so often that, taken as independent, they
        # would become the hidden label: where there are labels, dependence is
        # read from them
        known = label >= 0
        if (count * (label == 1)).sum() >= LABELLED and (count * (label == 0)).sum() >= LABELLED:
            self.correlations = self._residual(votes[known], count[known], (label[known] == 1).astype(float))
        else:
            q = self._em(votes, label, count, q, rounds)
            self.correlations = self._residual(votes, count, q)
        self.groups = self._clusters(self.correlations)
        q = self._em(votes, label, count, q, rounds)
        w1, w0 = q * count, (1 - q) * count
        self.sensitivity = (w1 @ votes) / max(w1.sum(), 1e-9)
        self.specificity = 1 - (w0 @ votes) / max(w0.sum(), 1e-9)
        self.accuracies = (w1 @ votes + w0 @ (1 - votes)) / max(count.sum(), 1e-9)

    @staticmethod
    def _start(votes, label, count) -> np.ndarray:
        q = np.array([0.03, 0.3, 0.8])[np.minimum(votes.sum(axis=1), 2)]
        return np.where(label == 1, np.maximum(q, 0.7), np.where(label == 0, np.minimum(q, 0.1), q))

    @staticmethod
    def _residual(votes, count, q) -> np.ndarray:
        """Correlations between voters given the hidden label."""
        cov = np.zeros((votes.shape[1],) * 2)
        for w in (q * count, (1 - q) * count):
            total = max(w.sum(), 1e-9)
            mean = (w @ votes) / total
            d = votes - mean
            cov += (d * w[:, None]).T @ d
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        return cov / sd[:, None] / sd[None, :]

    @staticmethod
    def _clusters(corr: np.ndarray, least: float = 0.2, most: int = 12) -> list[list[int]]:
        of = list(range(len(corr)))
        pairs = sorted(((-abs(corr[i, j]), i, j) for i in range(len(corr)) for j in range(i)))
        for c, i, j in pairs:
            a, b = of[i], of[j]
            if -c < least or a == b or of.count(a) + of.count(b) > most:
                continue
            of = [a if x == b else x for x in of]
        return [[j for j in range(len(corr)) if of[j] == g] for g in sorted(set(of))]

    def _em(self, votes, label, count, q, rounds) -> np.ndarray:
        codes = [sum(votes[:, j].astype(np.int64) << k for k, j in enumerate(g)) for g in self.groups]
        for _ in range(rounds):
            self.prior = float(np.clip((q * count).sum() / max(count.sum(), 1e-9), 1e-4, 0.999))
            self.tables = []
            for g, code in zip(self.groups, codes):
                size = 1 << len(g)
                both = [np.bincount(code, w * count, minlength=size) + min(0.5, 8 / size) for w in (1 - q, q)]
                self.tables.append([b / b.sum() for b in both])
            self.label_rates = []
            for w in (1 - q, q):
                n = [float((w * count)[label == v].sum()) for v in (0, 1)]
                self.label_rates.append((n[1] + 1) / (n[0] + n[1] + 2))
            # a label is wrong a tenth of the time at most
            self.label_rates = [min(self.label_rates[0], 0.1), max(self.label_rates[1], 0.9)]
            new = self.posterior(votes, label)
            if np.abs(new - q).max() < 1e-6:
                return new
            q = new
        return q

    def posterior(self, votes: np.ndarray, label: np.ndarray) -> np.ndarray:
        z = np.full(len(votes), np.log(self.prior) - np.log(1 - self.prior))
        for g, (t0, t1) in zip(self.groups, self.tables):
            code = sum(votes[:, j].astype(np.int64) << k for k, j in enumerate(g))
            z += np.log(t1[code]) - np.log(t0[code])
        r0, r1 = self.label_rates
        z += np.where(label == 1, np.log(r1 / r0), np.where(label == 0, np.log((1 - r1) / (1 - r0)), 0.0))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# ---- linear classifier ---------------------------------------------------------------
def fit_linear(
    votes: np.ndarray, rows: np.ndarray, feats: np.ndarray, size: int, target: np.ndarray, rounds: int = 300, l2: float = 1.0
) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic regression on soft labels: (bias, vote weights, feature weights)."""
    n = max(len(target), 1)
    b, wv, wf = 0.0, np.zeros(votes.shape[1]), np.zeros(size)
    acc = [1e-8, np.full(votes.shape[1], 1e-8), np.full(size, 1e-8)]
    v = votes.astype(np.float64)
    for _ in range(rounds):
        z = b + v @ wv + np.bincount(rows, wf[feats], minlength=len(target))
        d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        gb = d.sum() / n
        gv = (v.T @ d + 0.01 * l2 * wv) / n
        gf = (np.bincount(feats, d[rows], minlength=size) + l2 * wf) / n
        acc[0] += gb * gb
        acc[1] += gv * gv
        acc[2] += gf * gf
        b -= 0.5 * gb / np.sqrt(acc[0])
        wv -= 0.5 * gv / np.sqrt(acc[1])
        wf -= 0.2 * gf / np.sqrt(acc[2])
    return b, wv, wf


@dataclass
class Classifier:
    mined: Mined
    label_model: LabelModel
    bias: float
    vote_weights: np.ndarray
    feature_weights: np.ndarray


def _combinations(mined) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voting = Voting(mined.value)
        total: Counter = Counter()
        for batch in batches:
            for w, shape in _read(batch.column("text")):
                votes, _, _ = voting(w, shape)
                total.update(_coded(votes).tolist())
        cols = [pa.array(list(c), pa.int64()) for c in (total.keys(), total.values())]
        yield pa.record_batch(cols, ["code", "n"])

    return run


def _sample_votes(sample: pa.Table, mined: Mined) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``Voting`` tells of the sample, from what was collected of it."""
    ties = np.zeros((sample.num_rows, len(TIED)), np.int64)
    rows, feats, base = [], [], 0
    for kind, (name, hashes) in enumerate((("word", mined.words), ("begin", mined.begins), ("ending", mined.endings))):
        col = sample.column(name).combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.list_(pa.int64()))
        if len(col):
            off = col.offsets.to_numpy()
            h = col.values.to_numpy()[off[0] : off[-1]].view(np.uint64)
            owner = np.repeat(np.arange(len(col)), np.diff(off))
            at, which = Known(hashes).find(h)
            rows.append(owner[at])
            feats.append(which + base)
            n = np.bincount(owner[at], minlength=len(col))
            if kind == 0:
                ties[:, 0], ties[:, 1] = n > 0, n > 1
            else:
                ties[:, 1 + kind] = n > 0
        base += len(hashes)
    none = np.zeros(0, np.int64)
    code = sample.column("votes").to_numpy() if sample.num_rows else none
    votes = np.concatenate([(code[:, None] >> np.arange(len(UNLABELLED))) & 1, ties], axis=1)
    return votes, np.concatenate([none, *rows]), np.concatenate([none, *feats])


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    spark = docs.sparkSession
    drawn = sampling.labelled(docs, labels, "toxic", SAMPLE, SEED)
    found = drawn.mapInArrow(
        _sample_features,
        "doc_id bigint, row bigint, label int, votes bigint, word array<bigint>, begin array<bigint>, ending array<bigint>",
    )
    sample = sampling.collected(found)
    mined = mine(sample)
    own, rows, feats = _sample_votes(sample, mined)
    label = sample.column("label").to_numpy().astype(np.int64) if sample.num_rows else np.zeros(0, np.int64)
    # vote combinations: those of all documents, and those of the sample with
    # its labels in place of the same documents without
    shared = spark.sparkContext.broadcast(mined)
    combos = docs.select("text").mapInArrow(_combinations(shared), "code bigint, n bigint")
    got = combos.groupBy("code").agg(F.sum("n").alias("n")).collect()
    table = {r.code * 3: r.n for r in got}
    for code, n in Counter((_coded(own) * 3 + label + 1).tolist()).items():
        table[code] = n
        table[code - code % 3] = max(table.get(code - code % 3, 0) - n, 0)
    table = table or {0: 0}
    code = np.array(sorted(table), np.int64)
    count = np.array([table[c] for c in code], np.float64)
    votes = (code[:, None] // 3 >> np.arange(len(VOTERS))) & 1
    model = LabelModel(votes, code % 3 - 1, count)
    size = len(mined.words) + len(mined.begins) + len(mined.endings)
    target = model.posterior(own, label) if len(label) else np.zeros(0)
    b, wv, wf = fit_linear(own, rows, feats, size, target)
    if not len(label):  # nothing to train on: the label model's own odds
        odds = np.log(np.clip(model.sensitivity, 0.01, 0.99) / np.clip(1 - model.specificity, 0.01, 0.99))
        b, wv = float(np.log(model.prior / (1 - model.prior))), odds
    return Classifier(mined, model, b, wv, wf)


def scores(docs: DataFrame, model: Classifier, score: str = "score", votes: str = "votes") -> DataFrame:
    """``docs`` with a double score and the array of voters that fired, under
    the given names (columns of ``docs`` with these names are replaced)."""
    names = [c for c in docs.columns if c not in (score, votes)]
    schema = docs.select(*names, F.lit(0.0).alias(score), F.array(F.lit("")).alias(votes)).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        voting = Voting(m.mined)
        for batch in batches:
            for w, shape in _read(batch.column(names.index("text"))):
                fired, rows, feats = voting(w, shape)
                z = m.bias + fired @ m.vote_weights + np.bincount(rows, m.feature_weights[feats], minlength=w.rows)
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                voters = [[VOTERS[j] for j in np.flatnonzero(v)] for v in fired]
                part = batch.slice(w.lo, w.rows)
                yield pa.record_batch(
                    [*part.columns, pa.array(p), pa.array(voters, pa.list_(pa.string()))], [*names, score, votes]
                )

    return docs.select(*names).mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, votes per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    s = scores(rows, fit(docs, labels))
    return s.select(
        "doc_id",
        (common.fold("doc_id", sampling.FOLDS) == sampling.HELD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "votes",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    score, votes = common.free_names(docs, "__toxic_score", "__toxic_votes")
    s = scores(docs, fit(docs, labels), score, votes)
    return s.where(F.col(score) < THRESHOLD).select(*docs.columns)
