"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams (and of itself), a window of words the mean of its
words, and a linear softmax on top tells the classes apart.  Vectors and softmax are trained jointly in numpy.
Unseen spellings share n-grams, and so vectors, with known ones.  A few words make a document toxic, so a
document is as toxic as its worst window, of all that start at any of its words; training alternates between choosing
the worst window of each toxic document and fitting.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanternstats.llm.common import is_in_fold, ship, slices

#: Bound of what is learnt from: documents per class, whole texts.
SAMPLE_DOCS = 1_600
#: The model.
BUCKETS = 1 << 17
NGRAMS = (3, 4, 5)
DIM = 8
WINDOW = 6
#: Training: passes over all windows with their document's label, then rounds on the worst windows.
FIRST_EPOCHS = 1
ROUNDS = 8
#: Weight of the rarer class in the rounds, as a power of how much rarer it is.
LIFT = 0.5
RATE = 0.3
BATCH = 128
SEED = 7
THRESHOLD = 0.7
#: Remembered words of a task; beyond that it starts anew.
CACHE = 400_000
_SALTS = 16
_WORD = re.compile(r"[^\W_]+")


def words_of(text):
    return _WORD.findall(text.lower()) if text else []


def subwords(words, buckets=BUCKETS, ngrams=NGRAMS):
    """Buckets of the n-grams of each of ``words`` (not empty), one after the other, and how many each has."""
    marked = [f"<{w}>" for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    chars = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    end = np.cumsum(size)
    left = np.repeat(end, size) - np.arange(len(chars))  # characters from here to the end of the word
    owner = np.repeat(np.arange(len(words)), size)
    prime, found, whose = np.uint64(0x100000001B3), [], []
    for n in ngrams:
        h = np.full(max(len(chars) - n + 1, 0), n, np.uint64)
        for k in range(n):
            h = (h ^ chars[k : len(chars) - n + 1 + k]) * prime
        at = np.flatnonzero(left[: len(h)] >= n)
        found.append(h[at])
        whose.append(owner[at])
    # The whole word: a sum of its characters by position.
    power = np.uint64(0x9E3779B97F4A7C15)
    place = (np.arange(len(chars)) - np.repeat(end - size, size)).astype(np.uint64)
    mixed = (chars + np.uint64(1)) * (power * (place + np.uint64(1)) ^ (place * prime))
    found.append(np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), end - size))
    whose.append(np.arange(len(words)))
    h, whose = np.concatenate(found), np.concatenate(whose)
    h = (h ^ (h >> np.uint64(31))) * power
    order = np.argsort(whose, kind="stable")
    return (h[order] >> np.uint64(20)).astype(np.int64) % buckets, np.bincount(whose, minlength=len(words))


def means(values, sizes, window=WINDOW):
    """(mean, document) of every window of the documents, whose ``sizes`` values stand one after the other.

    A window starts at each word that has as many after it; a document of fewer words is one window.  Sums run
    along, so the work does not grow with the window.
    """
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    first, width = np.cumsum(sizes) - sizes, np.minimum(sizes, window)
    doc = np.repeat(np.arange(len(sizes)), sizes - width + 1)
    count = sizes - width + 1
    at = np.arange(len(doc)) + np.repeat(first - (np.cumsum(count) - count), count)
    return (sums[at + width[doc]] - sums[at]) / width[doc], doc, at


class Model:
    """Vectors of the buckets, the softmax, and their Adagrad sums."""

    def __init__(self, buckets=BUCKETS, dim=DIM, seed=SEED):
        random = np.random.default_rng(seed)
        # Near 0, so that n-grams which training never meets add nothing.
        self.vectors = random.uniform(-1e-3, 1e-3, (buckets, dim)).astype(np.float32)
        self.weights = random.uniform(-1, 1, (dim, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self.sums = [np.full_like(x, 1e-6) for x in (self.vectors, self.weights, self.bias)]

    def bucket_scores(self):
        """What each bucket adds to the log-odds; the model is linear in the buckets."""
        return self.vectors @ (self.weights[:, 1] - self.weights[:, 0]), float(self.bias[1] - self.bias[0])

    def update(self, grams, n_grams, word_ids, n_words, labels, weight, rate):
        """One step on a batch of windows; ``grams`` are those of the words that ``word_ids`` number."""
        starts = np.cumsum(n_grams) - n_grams
        word = np.add.reduceat(self.vectors[grams], starts) / n_grams[:, None]
        at = np.cumsum(n_words) - n_words
        hidden = np.add.reduceat(word[word_ids], at) / n_words[:, None]
        logits = hidden @ self.weights + self.bias
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(labels)), labels] -= 1
        p *= (weight / weight.sum())[:, None]
        d_hidden = p @ self.weights.T
        d_token = np.repeat(d_hidden / n_words[:, None], n_words, 0)
        d_word = np.stack([np.bincount(word_ids, d_token[:, k], len(n_grams)) for k in range(d_token.shape[1])], 1)
        d_gram = np.repeat(d_word / n_grams[:, None], n_grams, 0)
        used, place = np.unique(grams, return_inverse=True)
        d_vec = np.stack([np.bincount(place, d_gram[:, k], len(used)) for k in range(d_gram.shape[1])], 1)
        for value, total, grad, rows in (
            (self.vectors, self.sums[0], d_vec, used),
            (self.weights, self.sums[1], hidden.T @ p, slice(None)),
            (self.bias, self.sums[2], p.sum(0), slice(None)),
        ):
            total[rows] += grad**2
            value[rows] -= rate * grad / np.sqrt(total[rows])


def train(texts, labels, first_epochs=FIRST_EPOCHS, rounds=ROUNDS, rate=RATE, batch=BATCH, seed=SEED, window=WINDOW):
    """Scores of the buckets and bias; without both classes the bias alone, which says the class there is."""
    docs = [(w, y) for w, y in ((words_of(t), y) for t, y in zip(texts, labels)) if w]
    classes = {y for _, y in docs}
    if len(classes) < 2:
        return np.zeros(BUCKETS, np.float32), 20.0 if classes == {1} else -20.0
    ids = {}
    tokens = [np.fromiter((ids.setdefault(x, len(ids)) for x in w), np.int64, len(w)) for w, _ in docs]
    grams, n_grams = subwords(list(ids))
    gram_start = np.cumsum(n_grams) - n_grams
    flat, length = np.concatenate(tokens), np.array(list(map(len, tokens)))
    label = np.array([y for _, y in docs])
    model, random = Model(seed=seed), np.random.default_rng(seed)

    def ranges(start, count):
        return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())

    def windows(of):
        """(start, size, document) of windows side by side, from a word of each document drawn anew each time."""
        count, first = np.maximum(length[of] // window, 1), np.cumsum(length)[of] - length[of]
        rest = np.maximum(length[of] - count * window, 0)
        doc = np.repeat(of, count)
        start = ranges(np.zeros(len(of), np.int64), count) * window + np.repeat(first + random.integers(0, rest + 1), count)
        return start, np.minimum(length[doc], window), doc

    def epoch(begin, size, doc, lift):
        y = label[doc]
        share = np.bincount(y, minlength=2)
        weights = (np.maximum(len(y) / np.maximum(share, 1), 1) ** lift)[y]
        order = random.permutation(len(doc))
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            words, word_ids = np.unique(flat[ranges(begin[part], size[part])], return_inverse=True)
            model.update(
                grams[ranges(gram_start[words], n_grams[words])], n_grams[words], word_ids, size[part],
                y[part], weights[part], rate,
            )

    every, clean = np.arange(len(docs)), np.flatnonzero(label == 0)
    for _ in range(first_epochs):
        epoch(*windows(every), 1.0)
    for _ in range(rounds):
        scores, _ = model.bucket_scores()
        word = np.add.reduceat(scores[grams], gram_start) / n_grams
        score, doc, start = means(word[flat], length, window)
        by_doc = np.lexsort((-score, doc))
        worst = by_doc[np.append(True, np.diff(doc[by_doc]) > 0)]
        worst = worst[label[doc[worst]] == 1]
        of, start = doc[worst], start[worst]
        # For half of them another window with the worst word, so that what happens to stand beside it is not learnt.
        wide = np.minimum(length[of], window)
        inside = np.minimum(np.arange(window), wide[:, None] - 1)
        peak = start + word[flat[start[:, None] + inside]].argmax(1)
        begin = np.cumsum(length)[of] - length[of]
        other = np.clip(peak - random.integers(0, wide), begin, begin + length[of] - wide)
        toxic = np.where(random.random(len(of)) < 0.5, other, start), wide, of
        epoch(*map(np.concatenate, zip(toxic, windows(clean))), LIFT)
    return model.bucket_scores()


class Scorer:
    """Scores of documents; remembers the scores of words."""

    def __init__(self, scores, bias, window=WINDOW):
        self.scores, self.bias, self.window, self.seen = scores, bias, window, {}

    def __call__(self, texts):
        found = [words_of(t) for t in texts]
        new = set().union(*found)
        if len(self.seen) + len(new) > CACHE:
            self.seen.clear()
        new = [w for w in new if w not in self.seen]
        if new:
            grams, n = subwords(new)
            self.seen.update(zip(new, (np.add.reduceat(self.scores[grams], np.cumsum(n) - n) / n).tolist()))
        out = []
        for words in found:
            worst = self.bias
            if words:
                values = np.fromiter(map(self.seen.__getitem__, words), np.float64, len(words))
                worst += float(means(values, np.array([len(words)]), self.window)[0].max())
            out.append(float(1 / (1 + np.exp(-min(max(worst, -500.0), 500.0)))))
        return out


def training_rows(df, labels, id_col, text_col, label_col, fold, docs=SAMPLE_DOCS):
    """(whole text, label) of so many labelled documents of each class with the smallest hashes, outside the fold.

    Of rows that repeat an id one counts, so that no more than those texts come to the driver.
    """
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    if fold:
        rows = rows.where(~is_in_fold(id_col, *fold))
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    there = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"))
    keyed = rows.join(there, "id", "left_semi").withColumn("h", F.xxhash64("id"))
    rank = F.row_number().over(Window.partitionBy("label", F.pmod("h", F.lit(_SALTS))).orderBy("h", "id"))
    chosen = {r["id"]: r["label"] for r in keyed.withColumn("rank", rank).where(F.col("rank") <= docs // _SALTS).collect()}
    if not chosen:
        return []
    rows = df.where(F.col(id_col).isin(list(chosen)) & (F.length(text_col) > 0))
    found = rows.groupBy(F.col(id_col)).agg(F.min(text_col)).collect()
    return [(t, chosen[i]) for i, t in sorted((r for r in found if r[1]), key=lambda r: (str(r[0]), r[1]))]


def toxicity(df, labels, id_col="doc_id", text_col="text", label_col="toxic", fold=(3, 1), threshold=THRESHOLD):
    """Fold, score and prediction of each row of ``df``.

    Learns from the labelled rows outside the fold.  Null and empty texts, and those without a word, get the
    score of the bias.  If only one class is labelled, every score says that class; without labels all are
    near 0.  Each row is scored alone: null ids and repeated rows are returned as they are.  An id that is labelled
    twice counts as toxic if one label says so.  Texts of any length are learnt from and scored whole.  An empty
    table gives no rows.  Extra columns are left out.
    """
    pairs = training_rows(df, labels, id_col, text_col, label_col, fold)
    scores, bias = train([t for t, _ in pairs], [y for _, y in pairs])
    shared = df.sparkSession.sparkContext.broadcast((scores.astype(np.float32), bias))

    def run(batches):
        score = Scorer(*shared.value)
        for batch in slices(batches, 512):
            out = score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(out, pa.float64()), pa.array([int(x >= threshold) for x in out], pa.int32())],
                names=[id_col, "held_out", "score", "predicted"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    held_out = (is_in_fold(id_col, *fold) if fold else F.lit(False)).alias("held_out")
    return df.select(id_col, text_col, held_out).mapInArrow(
        run, f"`{id_col}` {id_type}, held_out boolean, score double, predicted int"
    )


ship(__name__)
