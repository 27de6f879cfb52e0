"""Languages of words, and so of texts, by a linear-chain conditional random field.

Words are runs of bytes other than x20 and x09 to x0D, in lower case. A word's scores for each language come from its
affixes, its inner character n-grams and the whole word as a lexicon entry, all hashed into one table of weights; learned
transition weights link neighbouring words. Forward-backward gives each word's probabilities; a text's are their mean over words that
hold a letter, and the largest is its language. So code-switched texts get the language of most of their words.

Weights are learned on the driver from at most PER_LANGUAGE labelled texts a language (the documented bound; those with the
smallest hashes; all languages are learned) by stochastic gradient on stretches of words, half of which join two languages at a
random place, so that transitions are learned as well. Scoring is one pass over the texts, without a shuffle. Sequences are
cut into blocks whose transfer matrices are multiplied, which is exact, and all blocks of a chunk run side by side.

Defined results: a null text, or one without a letter, is 'und' with score 0, as is every text if nothing was learned. A null
doc_id passes through. Repeated rows score alike. Columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._hashing import mix, words
from ledgerline.llm._spark import Stash, chunks, map_arrow, sized, texts_of

PER_LANGUAGE = 250
BITS = 17
STRETCH, STRETCHES, MINIBATCH, RATE, DECAY = 24, 9000, 48, 0.25, 1e-5
BLOCK = 64


def features(kinds: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, weight row) of all features of distinct words, over their full length."""
    flat = np.frombuffer(b"".join([b"\2" + w + b"\3" for w in kinds]), np.uint8).astype(np.uint64)
    size = np.array([len(w) + 2 for w in kinds], np.int64)
    begin = np.cumsum(size) - size
    word = np.repeat(np.arange(len(kinds)), size)
    owner, ids = [], []

    def put(which, value, kind):
        owner.append(which)
        ids.append((mix(value * np.uint64(64) + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64))

    acc = flat
    for n in (2, 3, 4):  # n-grams over the marked word: those at its ends are its affixes
        acc = acc[:-1] * np.uint64(257) + flat[n - 1 :]
        at = np.flatnonzero(word[: len(acc)] == word[n - 1 :])
        put(word[at], acc[at], n)
    place = (np.arange(len(flat)) - begin[word]).astype(np.uint64)
    put(np.arange(len(kinds)), mix(np.add.reduceat(mix(place * np.uint64(256) + flat), begin)), 9)
    return np.concatenate(owner), np.concatenate(ids)


def emissions(kinds: list[bytes], table: np.ndarray) -> np.ndarray:
    if not kinds:
        return np.zeros((0, table.shape[1]))
    owner, ids = features(kinds)
    return np.stack([np.bincount(owner, table[ids, k], minlength=len(kinds)) for k in range(table.shape[1])], axis=1)


def posteriors(scores: np.ndarray, sizes: np.ndarray, links: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Forward-backward. scores [words, labels] of sequences that follow each other with these sizes (none 0); links [labels, labels]."""
    n, k = scores.shape
    lift = np.exp(scores - scores.max(axis=1, keepdims=True))
    t = np.exp(links - links.max())
    per = -(-sizes // block)  # blocks of each sequence
    first = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(sizes)), per)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per)
    begin = first[of] + nth * block
    length = np.minimum(block, sizes[of] - nth * block)
    # a block's matrix: from the label before it to the label of its last word
    m = np.broadcast_to(np.eye(k), (len(of), k, k)).copy()
    for j in range(int(length.max())):
        on = np.flatnonzero(length > j)
        moved = m[on] @ t
        if j == 0:  # no link leads to a sequence's first word
            moved[nth == 0] = np.eye(k)
        step = moved * lift[begin[on] + j][:, None, :]
        m[on] = step / step.max(axis=(1, 2), keepdims=True)
    before, after = np.ones((len(of), k)), np.ones((len(of), k))
    start = np.cumsum(per) - per
    for j in range(1, int(per.max())):
        on = start[per > j] + j
        v = np.einsum("bi,bij->bj", before[on - 1], m[on - 1])
        before[on] = v / v.max(axis=1, keepdims=True)
    for j in range(2, int(per.max()) + 1):
        on = start[per >= j] + per[per >= j] - j
        v = np.einsum("bij,bj->bi", m[on + 1], after[on + 1])
        after[on] = v / v.max(axis=1, keepdims=True)
    out = np.empty((n, k))
    v = before
    for j in range(int(length.max())):
        on = np.flatnonzero(length > j)
        moved = v[on] @ t
        if j == 0:
            moved[nth == 0] = 1.0
        w = moved * lift[begin[on] + j]
        w /= w.max(axis=1, keepdims=True)
        v = v.copy() if j == 0 else v
        v[on] = w
        out[begin[on] + j] = w
    v = after.copy()
    for j in range(int(length.max()) - 1, -1, -1):
        on = np.flatnonzero(length > j)
        at = begin[on] + j
        out[at] *= v[on]
        w = (lift[at] * v[on]) @ t.T
        v[on] = w / w.max(axis=1, keepdims=True)
    return out / out.sum(axis=1, keepdims=True)


def chains(scores: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sequences of one length [sequences, words, labels]: each word's probabilities, and the expected number of each pair of neighbouring labels over all."""
    lift = np.exp(scores - scores.max(axis=2, keepdims=True))
    t = np.exp(links - links.max())
    ahead, behind = np.empty_like(lift), np.ones_like(lift)
    ahead[:, 0] = lift[:, 0]
    for j in range(1, lift.shape[1]):
        v = (ahead[:, j - 1] @ t) * lift[:, j]
        ahead[:, j] = v / v.max(axis=1, keepdims=True)
    for j in range(lift.shape[1] - 2, -1, -1):
        v = (lift[:, j + 1] * behind[:, j + 1]) @ t.T
        behind[:, j] = v / v.max(axis=1, keepdims=True)
    one = ahead * behind
    pairs = ahead[:, :-1, :, None] * t * (lift * behind)[:, 1:, None, :]
    return one / one.sum(axis=2, keepdims=True), (pairs / pairs.sum(axis=(2, 3), keepdims=True)).sum(axis=(0, 1))


class Field:
    """Languages, weights [2**BITS, languages] of features and [languages, languages] of links."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.table = np.zeros((1 << BITS, max(1, len(languages))))
        self.links = np.zeros((max(1, len(languages)),) * 2)

    def learn(self, texts: list[list[bytes]], labels: np.ndarray, seed: int = 11) -> None:
        """texts: the words of each text; labels: index of its language."""
        k, rng = len(self.languages), np.random.default_rng(seed)
        use = [i for i, w in enumerate(texts) if w]
        by = [[i for i in use if labels[i] == c] for c in range(k)]
        present = [c for c in range(k) if by[c]]
        if len(present) < 2:
            return
        kinds: dict[bytes, int] = {}
        coded = [np.array([kinds.setdefault(w, len(kinds)) for w in words_], np.int64) for words_ in texts]
        owner, ids = features(list(kinds))
        order = np.argsort(owner, kind="stable")
        ids, ends = ids[order], np.cumsum(np.bincount(owner, minlength=len(kinds)))

        def piece(c, n):
            words_ = coded[by[c][rng.integers(len(by[c]))]]
            at = rng.integers(max(1, len(words_) - n + 1))
            return np.resize(words_[at : at + n], n)

        square, square_links = np.full_like(self.table, 1e-3), np.full_like(self.links, 1e-3)
        for _ in range(STRETCHES // MINIBATCH):
            word = np.empty((MINIBATCH, STRETCH), np.int64)
            gold = np.empty((MINIBATCH, STRETCH), np.int64)
            for b in range(MINIBATCH):
                c = present[rng.integers(len(present))]
                word[b], gold[b] = piece(c, STRETCH), c
                if b % 2:
                    cut, d = rng.integers(3, STRETCH - 3), present[rng.integers(len(present))]
                    word[b, cut:], gold[b, cut:] = piece(d, STRETCH - cut), d
            distinct, back = np.unique(word, return_inverse=True)
            begin = np.where(distinct > 0, ends[distinct - 1], 0)
            count = ends[distinct] - begin
            mine = np.repeat(np.arange(len(distinct)), count)
            rows = ids[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)]
            e = np.stack([np.bincount(mine, self.table[rows, c], minlength=len(distinct)) for c in range(k)], axis=1)
            p, joint = chains(e[back.ravel()].reshape(MINIBATCH, STRETCH, k), self.links)
            wrong = -p.reshape(-1, k)
            wrong[np.arange(len(wrong)), gold.ravel()] += 1
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
            grad_links = (seen - joint) / MINIBATCH / STRETCH
            by_word = np.stack([np.bincount(back.ravel(), wrong[:, c], minlength=len(distinct)) for c in range(k)], axis=1)
            touched, where = np.unique(rows, return_inverse=True)
            grad = np.stack([np.bincount(where, by_word[mine, c], minlength=len(touched)) for c in range(k)], axis=1) / MINIBATCH - DECAY * self.table[touched]
            square[touched] += grad**2
            self.table[touched] += RATE * grad / np.sqrt(square[touched])
            square_links += grad_links**2
            self.links += 0.1 * grad_links / np.sqrt(square_links)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of each word's languages, its text, and whether it holds a letter."""
        hashes, starts, ends, owner = words(texts)
        joined = b" ".join([b"", *texts, b""])
        codes, distinct = pd.factorize(hashes)
        first = np.full(len(distinct), -1, np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        kinds = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        letters = np.array([w.isalpha() or any(c.isalpha() for c in w.decode("utf-8", "replace")) for w in kinds], bool)
        sizes = np.bincount(owner, minlength=len(texts))
        p = posteriors(emissions(kinds, self.table)[codes], sizes[sizes > 0], self.links) if len(codes) else np.zeros((0, self.table.shape[1]))
        return p, owner, letters[codes] if len(codes) else np.zeros(0, bool)


def lower(text: bytes) -> bytes:
    return text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()


def train(docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE) -> Field:
    """docs: (doc_id, text, lang); usable: which rows may be learned from."""
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    # the texts with the smallest hashes of each language: narrow rows, of which a task hands on per_language at most
    narrow = known.select("lang", F.xxhash64(F.lit("language"), "doc_id", "text").alias("draw"))
    kinds = Stash(narrow.distinct())
    # hashes below a share that holds about 1.5 times what is wanted, so that little of a language is put in order
    share = F.least(F.lit(1.0), F.lit(1.5 * (per_language + 50)) / F.count("*"))
    shares = kinds.read().groupBy("lang").agg(share.alias("share")).withColumnRenamed("lang", "l")
    low = F.pmod("draw", F.lit(1 << 40)) <= F.col("share") * float(1 << 40)
    drawn = kinds.read().join(sized(Stash(shares).read()), F.col("lang") == F.col("l")).where(low)
    first = Window.partitionBy("lang").orderBy(F.pmod("draw", F.lit(1 << 40)), "draw")
    chosen = Stash(drawn.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_language).select(F.col("lang").alias("l"), "draw"))
    own = known.withColumn("draw", F.xxhash64(F.lit("language"), "doc_id", "text"))
    drawn = own.join(sized(chosen.read()).withColumnRenamed("draw", "d"), (F.col("draw") == F.col("d")) & (F.col("lang") == F.col("l")))
    # per_language texts a language; repeated rows count once
    rows = drawn.groupBy("lang", "draw").agg(F.min("text").alias("text")).toArrow().to_pandas()
    rows = rows.sort_values(["lang", "draw"], kind="stable")
    field = Field(sorted(rows["lang"].unique().tolist()))
    index = {c: i for i, c in enumerate(field.languages)}
    field.learn([lower(t.encode()).split() for t in rows["text"]], np.array([index[c] for c in rows["lang"]], np.int64))
    return field


def predict(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of docs; score: the mean probability of that language over words."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast((field.languages, field.table.astype(np.float32), field.links))

    def run(batches):
        languages, table, links = shared.value
        own = Field([])
        own.languages, own.table, own.links = languages, table, links
        for batch in chunks(batches):
            texts = [lower(t) for t in texts_of(batch)]
            p, owner, letters = own.words(texts)
            n = np.bincount(owner, letters, minlength=len(texts))
            mean = np.stack([np.bincount(owner, p[:, c] * letters, minlength=len(texts)) for c in range(table.shape[1])], axis=1) / np.maximum(n, 1)[:, None]
            best = mean.argmax(axis=1)
            named = [languages[b] if m and languages else "und" for b, m in zip(best, n, strict=True)]
            value = np.where([x != "und" for x in named], mean[np.arange(len(best)), best], 0.0) if len(named) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(named, pa.string()), pa.array(np.clip(value, 0, 1).astype(float))], names=["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")
