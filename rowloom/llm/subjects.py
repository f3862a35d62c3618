"""The subjects of each document.

Method: term weighting and truncated singular value decomposition, then cosine similarity to seed centroids that are
refined iteratively.

1. Every text is read and cut into sentences and terms once; what is kept are numbers, and every later pass is a few
   array operations per thousand documents. Terms are words of three letters or more, fixed phrases of two words
   (those that stand together far more often than chance) and, in sentences with Chinese characters, pairs of these; a
   sentence's script is its own. Counts are taken over all documents. Terms in less than `rare` or more than `common` of
   the documents with a script are left out, so the vocabulary is at most the mean number of terms of a document over
   `rare`, whatever the number of documents.
2. Documents (their parts in each script) are weighted by (1 + log tf) * idf and unit length. The leading right singular
   vectors of the document-term matrix come from block power iteration: each pass sums A'(A Y) over all documents by
   term, and only the (vocabulary x rank) result reaches the driver. Each script has its own vectors.
3. Seed centroids are the mean embeddings of the documents that people labelled with a subject, and the words of its
   description. They are refined: every sentence goes to the centroid that its terms, weighted by how clearly
   their vectors point to one centroid against the mean of all, are most similar to, and centroids become the
   means of their sentences.
4. Term weights are refined on the documents: a term's clarity is the share of one subject among the documents that hold
   it, beyond that subject's share of all. Words that merely look like a subject's lose their weight in this way.
5. Sentences are embedded as the sums of their terms' vectors, weighted by clarity; centroids are refined in that
   embedding, and each sentence gets the subject whose centroid it is most similar to by cosine.
6. A document is about the subjects of at least `share` of its sentences, if at least one of these is clear: the clarity
   of its terms for that subject reaches `clear`.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship
from .plainform import plain

RARE, COMMON, PHRASE = 0.001, 0.3, 30.0
POWER_PASSES, CENTROID_ROUNDS, CLARITY_ROUNDS, COSINE_ROUNDS = 5, 3, 4, 2
SHARE, CLEAR, HINT, SEED_EVIDENCE = 0.1, 0.95, 0.4, 0.6
_SENTENCE = re.compile(r"[.!?。！？]+|\n\s*\n")
_HAN = "㐀-䶿一-鿿"
_TERM = re.compile(f"[{_HAN}]+|[^\\W\\d_{_HAN}]+")
_LETTER = re.compile(r"\w")
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Documents whose matrix is multiplied at once.
ROWS = 1000


class Tokeniser:
    """Terms of texts as 64-bit hashes, which differ by script (1: the sentence holds Chinese characters)."""

    def __init__(self):
        self.known: tuple[dict[str, int], dict[str, int]] = ({}, {})

    def _hash(self, term: str, script: int) -> int:
        known = self.known[script]
        if (h := known.get(term)) is None:
            if len(known) > 500_000:
                known.clear()
            h = known[term] = xxhash.xxh3_64_intdigest(term.encode("utf-8", "surrogatepass"), script) >> 1
        return h

    def sentences(self, text: str | None) -> list[tuple[int, list[int]]]:
        """(script, terms) of each sentence: words of three letters or more, pairs of Chinese characters."""
        out = []
        for part in _SENTENCE.split(text or ""):
            s = plain(part).lower()
            if not _LETTER.search(s):
                continue
            terms, script = [], 0
            for t in _TERM.findall(s):
                if "㐀" <= t[0] <= "鿿":
                    script = 1
                    terms += [t[i : i + 2] for i in range(len(t) - 1)] or [t]
                elif len(t) > 2:
                    terms.append(t)
            out.append((script, [self._hash(t, script) for t in terms]))
        return out


TOKENS = "doc_id long, terms array<long>, ends array<int>, scripts array<int>"


def _tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, terms, ends, scripts): the terms of all sentences, where each sentence ends among them, its script."""

    def run(batches):
        tokeniser = Tokeniser()
        for b in batches:
            out = []
            for d, t in zip(b["doc_id"], b["text"]):
                sents = tokeniser.sentences(t)
                terms = [h for _, ts in sents for h in ts]
                out.append((d, terms, np.cumsum([len(ts) for _, ts in sents], dtype="int32"), [s for s, _ in sents]))
            yield pd.DataFrame(out, columns=["doc_id", "terms", "ends", "scripts"])

    return docs.mapInPandas(run, TOKENS)


def _list(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists."""
    column = batch.column(batch.schema.get_field_index(name))
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), (offsets - offsets[0]).astype("int64")


class Sentences:
    """The terms of a batch of documents: `terms` in order, of each its sentence and document, of each sentence its
    document and script, and `n` of each document."""

    def __init__(self, batch: pa.RecordBatch, terms: str):
        self.terms, at = _list(batch, terms)
        ends, sents = _list(batch, "ends")
        self.script = _list(batch, "scripts")[0]
        self.n = np.diff(sents)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        ends = ends + at[self.doc]
        self.size = np.diff(ends, prepend=0)
        self.sent = np.repeat(np.arange(len(ends)), self.size)

    def merged(self, phrases: np.ndarray) -> None:
        """Put a phrase's hash in place of its two words, from left to right."""
        if not len(phrases) or len(self.terms) < 2:
            return
        both = pair_hash(self.terms[:-1], self.terms[1:])
        starts = (self.sent[:-1] == self.sent[1:]) & _among(both, phrases)
        at = np.arange(len(starts))
        run = np.maximum.accumulate(np.where(starts & ~np.r_[False, starts[:-1]], at, -1))
        taken = starts & ((at - run) % 2 == 0)
        terms = self.terms.copy()
        terms[:-1][taken] = both[taken]
        stay = ~np.r_[False, taken]
        self.terms, self.sent = terms[stay], self.sent[stay]
        self.size = np.bincount(self.sent, minlength=len(self.size))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a.view(np.uint64) * _STEP ^ (a.view(np.uint64) >> np.uint64(31))) * _MIX + b.view(np.uint64) * _STEP
    return ((x ^ x >> np.uint64(29)) * _MIX >> np.uint64(1)).view(np.int64)


def _among(values: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values if len(sorted_keys) else np.zeros(len(values), bool)


def _arrow(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _counted(tokens: DataFrame, emit, columns: str, floor: dict[int, float]) -> list:
    """Sums of n by key columns and script, of those at or above the floor of their script.

    emit(sentences) gives (key columns, script, n) of a batch; the counts are merged within a batch and before the shuffle.
    """

    def run(batches):
        for b in batches:
            yield _arrow(emit(Sentences(b, "terms")))

    keys = [c.split()[0] for c in columns.split(", ")]
    sums = tokens.mapInArrow(run, f"{columns}, script int, n long").groupBy(*keys, "script").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= F.when(F.col("script") == 1, floor[1]).otherwise(floor[0])).collect()


class Vocabulary:
    """Terms of both scripts by the hash of each, with their idf; and the phrases."""

    def __init__(self, rows: list, sizes: dict[int, int], phrases: np.ndarray):
        kept = sorted((r.key, r.script, r.n) for r in rows if r.n <= max(2, COMMON * sizes[r.script]))
        self.phrases = phrases
        self.keys = np.array([k for k, *_ in kept], "int64")
        self.script = np.array([s for _, s, _ in kept], "int64")
        self.idf = np.array([np.log((sizes[s] + 1) / (n + 1)) for _, s, n in kept])

    def __len__(self) -> int:
        return len(self.keys)

    def encode(self, x: Sentences) -> None:
        """Keep the terms of the vocabulary, as numbers, each once per sentence."""
        x.merged(self.phrases)
        known = _among(x.terms, self.keys)
        ids = np.searchsorted(self.keys, x.terms[known])
        once = np.unique(x.sent[known] * len(self) + ids)
        x.sent, x.terms = once // len(self), once % len(self)
        x.size = np.bincount(x.sent, minlength=len(x.size))


def learn_vocabulary(tokens: DataFrame, rare: float = RARE, phrase: float = PHRASE) -> Vocabulary:
    def documents(x: Sentences) -> dict:
        parts = np.unique(x.doc * 2 + x.script) % 2
        return {"key": np.array([0, 0]), "script": np.array([0, 1], "int32"), "n": np.bincount(parts, minlength=2)}

    def words(x: Sentences) -> dict:
        key, n = np.unique(x.terms[x.script[x.sent] == 0], return_counts=True)
        return {"key": key, "script": np.zeros(len(key), "int32"), "n": n}

    sizes = {0: 0, 1: 0} | {r.script: r.n for r in _counted(tokens, documents, "key long", {0: 0, 1: 0})}
    floor = {s: max(3.0, rare * n) for s, n in sizes.items()}
    n = {r.key: r.n for r in _counted(tokens, words, "key long", floor)}
    often = np.array(sorted(n), "int64")

    def pairs(x: Sentences) -> dict:
        ok = _among(x.terms, often)
        ok = ok[:-1] & ok[1:] & (x.sent[:-1] == x.sent[1:])
        a, b = x.terms[:-1][ok], x.terms[1:][ok]
        _, first, n = np.unique(pair_hash(a, b), return_index=True, return_counts=True)
        return {"a": a[first], "b": b[first], "script": np.zeros(len(first), "int32"), "n": n}

    total, least = sum(n.values()), floor[0]
    close = [(r.a, r.b) for r in _counted(tokens, pairs, "a long, b long", floor) if (r.n - least / 2) * total / (n[r.a] * n[r.b]) > phrase]
    a, b = (np.array(x, "int64") for x in (zip(*close) if close else ((), ())))
    phrases = np.sort(pair_hash(a, b))

    def terms(x: Sentences) -> dict:
        x.merged(phrases)
        script = x.script[x.sent]
        # Each term once per document.
        _, first = np.unique(x.terms.view(np.uint64) + x.doc[x.sent].astype(np.uint64) * _STEP, return_index=True)
        key, at, n = np.unique(x.terms[first], return_index=True, return_counts=True)
        return {"key": key, "script": script[first][at].astype("int32"), "n": n}

    return Vocabulary(_counted(tokens, terms, "key long", floor), sizes, phrases)


CODES = "doc_id long, ids array<int>, ends array<int>, scripts array<int>, vector array<int>, parts array<int>, weights array<float>"


def encoded(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, ends, scripts, vector, parts, weights): the terms of each sentence as numbers; and of the document's
    part in each script the terms, the script of each, and their weights (1 + log tf) * idf, of unit length per part."""

    def lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(values))

    def run(batches):
        for b in batches:
            x = Sentences(b, "terms")
            vocabulary.encode(x)
            v, docs = len(vocabulary), len(x.n)
            doc = x.doc[x.sent]
            at, tf = np.unique((doc * 2 + vocabulary.script[x.terms]) * v + x.terms, return_counts=True)
            part, ids = at // v, at % v
            w = (1 + np.log(tf)) * vocabulary.idf[ids]
            norm = np.sqrt(np.bincount(part, w * w, minlength=2 * docs))
            w /= np.where(norm > 0, norm, 1.0)[part]
            in_doc = np.bincount(doc, minlength=docs)
            ends = np.cumsum(x.size) - (np.cumsum(in_doc) - in_doc)[x.doc]
            of = np.bincount(part // 2, minlength=docs)
            columns = [b.column(0), lists(x.terms.astype("int32"), in_doc), lists(ends.astype("int32"), x.n), lists(x.script.astype("int32"), x.n)]
            columns += [lists(ids.astype("int32"), of), lists((part % 2).astype("int32"), of), lists(w.astype("float32"), of)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in CODES.split(", ")])

    return tokens.mapInArrow(run, CODES)


class Parts:
    """The document vectors of a batch: term, weight and part of every entry; a part is a document in a script."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids, offsets = _list(batch, "vector")
        self.ids = self.ids.astype("int64")
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.part = self.doc * 2 + _list(batch, "parts")[0]
        self.w = _list(batch, "weights")[0].astype("float64")
        self.starts = np.flatnonzero(np.r_[True, self.part[1:] != self.part[:-1]]) if len(self.part) else np.array([], "int64")

    def project(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(part, its vector times y)."""
        if not len(self.starts):
            return self.starts, np.zeros((0, y.shape[1]))
        return self.part[self.starts], np.add.reduceat(y[self.ids] * self.w[:, None], self.starts, axis=0)


def _slices(batches, rows: int = ROWS):
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def _summed(df: DataFrame, add, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all batches of what `add` adds to a matrix of this shape, which is bounded by the vocabulary. Every
    task sends the rows that are not zero."""
    names = [f"y{i}" for i in range(shape[1])]

    def run(batches):
        total = np.zeros(shape)
        for b in _slices(batches):
            add(b, total)
        at = np.flatnonzero(total.any(axis=1))
        yield _arrow({"at": at, **dict(zip(names, total[at].T))})

    rows = df.mapInArrow(run, "at long, " + ", ".join(f"{c} double" for c in names)).groupBy("at").agg(*(F.sum(c).alias(c) for c in names)).collect()
    out = np.zeros(shape)
    if rows:
        out[[r[0] for r in rows]] = [r[1:] for r in rows]
    return out


def _spread(total: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """total[at] += values, with repeated places."""
    for k in range(values.shape[1]):
        total[:, k] += np.bincount(at, values[:, k], minlength=len(total))


def singular_vectors(codes: DataFrame, vocabulary: Vocabulary, rank: int, passes: int = POWER_PASSES) -> np.ndarray:
    """(vocabulary x rank): per script the leading right singular vectors of its documents."""
    y = np.random.default_rng(11).standard_normal((len(vocabulary), rank))
    vectors = codes.select("vector", "parts", "weights")

    def orthonormal(y: np.ndarray) -> np.ndarray:
        out = np.zeros_like(y)
        for s in (0, 1):
            at = np.flatnonzero(vocabulary.script == s)
            if len(at):
                q, _ = np.linalg.qr(y[at])
                out[at, : q.shape[1]] = q
        return out

    for _ in range(passes):
        y = orthonormal(y)

        def add(b, total, y=y):
            p = Parts(b)
            _, z = p.project(y)
            sizes = np.diff(np.r_[p.starts, len(p.ids)])
            _spread(total, p.ids, np.repeat(z, sizes, axis=0) * p.w[:, None])

        y = _summed(vectors, add, y.shape)
    return orthonormal(y)


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(n > 0, n, 1.0)


def _sentence_sums(x: Sentences, table: np.ndarray) -> np.ndarray:
    """Per sentence the sum of its terms' rows of a table."""
    out = np.zeros((len(x.size), table.shape[1]))
    some = x.size > 0
    if some.any():
        starts = (np.cumsum(x.size) - x.size)[some]
        out[some] = np.add.reduceat(table[x.terms], starts, axis=0)
    return out


class Model:
    """Term vectors, centroids (script x subject) and the gain of each term for each subject."""

    def __init__(self, vocabulary: Vocabulary, vectors: np.ndarray, subjects: list[str]):
        self.vocabulary, self.vectors, self.subjects = vocabulary, _unit(vectors), subjects
        self.weighted = vectors * vocabulary.idf[:, None]
        self.centroids = np.zeros((2, len(subjects), vectors.shape[1]))
        self.gain = np.zeros((len(vocabulary), len(subjects)))
        self.clear: np.ndarray | None = None

    def weigh(self) -> None:
        """From here on sentences are embedded by the clarity of their terms, and the cosine assigns them."""
        self.clear = self.vectors * self.gain.max(axis=1, keepdims=True)

    def embedded(self, x: Sentences) -> np.ndarray:
        return _sentence_sums(x, self.weighted if self.clear is None else self.clear)

    def assign(self, x: Sentences, first: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per sentence: its subject, the evidence for it in the gains of its terms, and the subject's share of all
        evidence. Until terms are weighed by clarity (`first`: still) the subject is that of most evidence, then the one
        whose centroid is most similar by cosine."""
        scores = _sentence_sums(x, self.gain)
        best = scores.argmax(axis=1)
        if self.clear is not None and not first:
            e = self.embedded(x)
            for s in (0, 1):
                at = np.flatnonzero(x.script == s)
                best[at] = (e[at] @ self.centroids[s].T).argmax(axis=1)
        top = scores[np.arange(len(scores)), best]
        total = scores.sum(axis=1)
        return best, top, top / np.where(total > 0, total, 1.0)

    def point(self) -> None:
        """Gains from the cosine between term vectors and centroids, both taken against the centroids' mean."""
        for s in (0, 1):
            c = self.centroids[s]
            known = c.any(axis=1)
            if not known.any():
                continue
            away = _unit((c - c[known].mean(axis=0)) * known[:, None]) if known.sum() > 1 else c
            at = np.flatnonzero(self.vocabulary.script == s)
            cosine = np.clip(self.vectors[at] @ away.T, 0, 1)
            self.gain[at] = cosine * cosine.max(axis=1, keepdims=True) ** 3


def _seeds(codes: DataFrame, labels: DataFrame, descriptions: dict[str, str], model: Model) -> None:
    subjects, rank = model.subjects, model.vectors.shape[1]
    n = len(subjects)
    number = F.create_map(*(x for i, s in enumerate(subjects) for x in (F.lit(s), F.lit(i))))
    said = labels.where("doc_id IS NOT NULL").select("doc_id", number[F.col("subject")].alias("k")).where("k IS NOT NULL").distinct()
    # Labels may be few or many; the join is on doc_id, which is unique among documents.
    labelled = codes.join(said, "doc_id").select("vector", "parts", "weights", "k")

    def add(b, total):
        part, z = Parts(b).project(model.weighted)
        k = b.column(b.schema.get_field_index("k")).to_numpy(zero_copy_only=False)
        _spread(total, part % 2 * n + k[part // 2], _unit(z))

    seeds = _summed(labelled, add, (2 * n, rank))
    tokeniser = Tokeniser()
    for k, s in enumerate(subjects):
        sents = tokeniser.sentences(f"{descriptions.get(s) or ''}. {s}")
        terms = np.array([h for _, ts in sents for h in ts], "int64")
        ends = np.cumsum([len(ts) for _, ts in sents], dtype="int32")
        b = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((terms, pa.list_(pa.int64())), (ends, pa.list_(pa.int32())), ([s for s, _ in sents], pa.list_(pa.int32())))], names=["terms", "ends", "scripts"])
        x = Sentences(b, "terms")
        model.vocabulary.encode(x)
        for script in (0, 1):
            ids, tf = np.unique(x.terms[model.vocabulary.script[x.terms] == script], return_counts=True)
            if len(ids):
                w = (1 + np.log(tf)) * model.vocabulary.idf[ids]
                seeds[script * n + k] += _unit(w @ model.weighted[ids])
    model.centroids = _unit(seeds).reshape(2, n, rank)


def _refine_centroids(sents: DataFrame, model: Model, first: bool = False) -> None:
    n, rank = len(model.subjects), model.vectors.shape[1]

    def add(b, total):
        x = Sentences(b, "ids")
        best, evidence, share = model.assign(x, first)
        sure = (evidence > SEED_EVIDENCE) & (share > 0.6)
        _spread(total, (x.script * n + best)[sure], _unit(model.embedded(x)[sure]))

    sums = _summed(sents, add, (2 * n, rank))
    moved = model.centroids.reshape(2 * n, rank).copy()
    some = sums.any(axis=1)
    moved[some] = _unit(sums[some])
    model.centroids = moved.reshape(2, n, rank)


def _measure_clarity(codes: DataFrame, model: Model, least: float) -> None:
    n, size = len(model.subjects), len(model.vocabulary)

    def add(b, total):
        x, p = Sentences(b, "ids"), Parts(b)
        best, evidence, share = model.assign(x)
        sure = (evidence > least) & (share > 0.6)
        of = (x.doc * 2 + x.script)[sure]
        mix = np.bincount(of * n + best[sure], minlength=2 * len(x.n) * n).reshape(-1, n).astype("float64")
        said = mix.sum(axis=1)
        row = np.c_[mix / np.where(said > 0, said, 1.0)[:, None], np.ones(len(mix))]
        _spread(total, p.ids, row[p.part])
        some = np.flatnonzero(said > 0)
        _spread(total, size + some % 2, row[some])

    table = _summed(codes, add, (size + 2, n + 1))
    for s in (0, 1):
        if not table[size + s, n]:
            continue
        usual = table[size + s, :n] / table[size + s, n]
        at = np.flatnonzero(model.vocabulary.script == s)
        held = (table[at, :n] + 2 * usual) / (table[at, n] + 2)[:, None]
        lift = np.clip((held - usual) / np.where(usual < 1, 1 - usual, 1.0), 0, 1)
        model.gain[at] = np.where(lift >= 0.35 * lift.max(axis=1, keepdims=True), lift, 0) ** 2


def document_subjects(
    documents: DataFrame, subjects: DataFrame, labels: DataFrame, share: float = SHARE, clear: float = CLEAR, hint: float = HINT
) -> DataFrame:
    """(doc_id, subject): every subject that at least `share` of a document's sentences deal with.

    documents: doc_id, text; subjects: subject, description; labels: doc_id, subject. Null ids, texts without a word and
    labels with a null or an unknown subject are ignored; repeated labels count once. Without labels for a subject
    its description alone seeds it. A document none of whose sentences is clear gets the subject with most hints, if
    any; none gives no row.
    """
    spark = ship(documents.sparkSession)
    scratch = Scratch(spark)
    listed = {r.subject: r.description for r in subjects.where("subject IS NOT NULL").groupBy("subject").agg(F.min("description").alias("description")).collect()}
    docs = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    schema = "doc_id long, subject string"
    if not listed:
        return spark.createDataFrame([], schema)
    tokens = scratch.keep(_tokens(docs))
    vocabulary = learn_vocabulary(tokens)
    if not len(vocabulary):
        return spark.createDataFrame([], schema)
    names = sorted(listed)
    codes = scratch.keep(encoded(tokens, vocabulary))
    scratch.drop(tokens)
    model = Model(vocabulary, singular_vectors(codes, vocabulary, 2 * len(names)), names)
    _seeds(codes, labels, listed, model)
    model.point()
    for _ in range(CENTROID_ROUNDS):
        _refine_centroids(codes.select("ids", "ends", "scripts"), model)
        model.point()
    for i in range(CLARITY_ROUNDS):
        _measure_clarity(codes.drop("doc_id"), model, 0.5 if i else SEED_EVIDENCE)
    model.weigh()
    for i in range(COSINE_ROUNDS):
        _refine_centroids(codes.select("ids", "ends", "scripts"), model, first=not i)

    def run(batches):
        for b in _slices(batches):
            x = Sentences(b, "ids")
            best, evidence, part = model.assign(x)
            k, docs = len(names), len(x.n)
            counts = lambda on: np.bincount((x.doc * k + best)[on], minlength=docs * k).reshape(docs, k)
            n = counts((evidence >= hint) & (part >= 0.5))
            enough = (n >= share * x.n[:, None]) & (x.n[:, None] > 0)
            found = enough & (counts((evidence >= clear) & (part >= 0.6)) > 0)
            none = ~found.any(axis=1) & (n.max(axis=1) >= share * x.n) & (x.n > 0)
            found[none, n.argmax(axis=1)[none]] = True
            at, which = np.nonzero(found)
            ids = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array([names[i] for i in which], pa.string())], names=["doc_id", "subject"])

    return codes.select("doc_id", "ids", "ends", "scripts").mapInArrow(run, schema)


def composition(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(subject, lang, n_documents, n_chars): how much of the corpus each subject takes, by language."""
    sized = documents.select("doc_id", "lang", F.length("text").alias("chars"))
    return found.join(sized, "doc_id").groupBy("subject", "lang").agg(F.count("*").alias("n_documents"), F.sum("chars").alias("n_chars"))
