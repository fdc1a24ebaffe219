"""Language-model scoring: subword lattice likelihood.

The vocabulary is an existing one of subwords, to which every word of the training texts is a further entry.
A token's probability is the sum over all ways to put it together from entries: as a word, or spelt with
subwords, of which a forward recursion in log space adds up every segmentation.  What the spelling is worth as
a whole is the share of words seen once among the training tokens; subword scores start from the vocabulary's
ranks and are fitted on the distinct training words by expectation maximisation.  Subwords never cross white
space, so a document's probability is the product over its tokens.

The most frequent words, a fixed number, are looked up in the task; every other word of a document meets its
count in a join, in which no training word is more frequent than the last of those.
"""

import math
from array import array

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from lanternstats.llm.common import is_in_fold, ship, slices, stored, workspace

#: Most words that every task holds.
HEAD = 200_000
#: Passes of expectation maximisation.
PASSES = 2
#: Added to the expected count of each subword.
FLOOR = 0.05
#: A task sends its word counts on when it has so many different words.
FLUSH = 400_000
#: Words of so many characters are scored and learnt from one by one.
LONG = 256
MARK = "▁"
_CELLS = 60_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 10**6


def load_vocabulary(path):
    """Subwords that begin a word or lie in one, with scores from their ranks; 256 bytes come last."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or MARK in piece[1:]):
            pieces.append(piece)
            ranks.append(len(pieces))
    share = np.concatenate([1 / np.array(ranks, float), np.full(256, 1e-4)])
    return pieces, np.log(share / share.sum())


def _hash(chars):
    """Hash of each row of a matrix of characters."""
    h = np.zeros(len(chars), np.uint64)
    for k in range(chars.shape[1]):
        h = _step(h, chars[:, k])
    return h


def _step(h, c):
    h = (h ^ c) * _PRIME
    return h ^ (h >> np.uint64(32))


class Lattice:
    """Sums over all segmentations of words into subwords."""

    def __init__(self, pieces, scores):
        self.scores, self.n = np.asarray(scores, np.float64), len(pieces)
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        keys = np.zeros(len(pieces), np.uint64)
        size = np.array(list(map(len, pieces)))
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            chars = np.array([[ord(c) for c in pieces[i]] for i in at], np.uint64)
            keys[at] = _hash(chars)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.may = np.zeros(1 << 20, bool)
        self.may[(keys >> np.uint64(44)).astype(np.int64)] = True

    def find(self, h):
        """Number of the subword of each hash, -1 for none."""
        out = np.full(h.shape, -1, np.int32)
        at = np.nonzero(self.may[(h >> np.uint64(44)).astype(np.int64)])
        some = h[at]
        place = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        out[at] = np.where(self.keys[place] == some, self.order[place], -1)
        return out

    def log_probabilities(self, words, counts=None):
        """Natural logarithm of each word's probability; adds expected uses of subwords to ``counts``."""
        out = np.zeros(len(words))
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        order = np.argsort(size, kind="stable")
        at = 0
        while at < len(order):
            if size[order[at]] > LONG:
                out[order[at]] = self.long(words[order[at]], counts)
                at += 1
                continue
            rows = max(1, int(_CELLS // size[order[at]]))
            part = order[at : at + rows]
            part = part[size[part] <= max(2 * size[part[0]], 16)]
            part = part[size[part] <= LONG]
            out[part] = self.batch([words[i] for i in part], size[part], counts)
            at += len(part)
        return out

    def batch(self, words, size, counts):
        n, width = len(words), int(size[-1])
        flat = np.frombuffer((MARK + MARK.join(words)).encode("utf-32-le"), np.uint32)
        chars = np.zeros((n, width), np.uint64)
        inside = np.arange(width)[None, :] < size[:, None]
        chars[inside] = flat
        # pieces[l-1][:, i]: the subword of length l that begins at i.
        pieces, h = [], np.zeros((n, width), np.uint64)
        for k in range(min(self.longest, width)):
            h = _step(h[:, : width - k], chars[:, k:])
            found = self.find(h)
            found[~inside[:, k:]] = -1
            pieces.append(found)
        spelt = np.where(pieces[0] < 0, self.bytes_of(chars, pieces[0] < 0), 0.0)
        table = np.append(self.scores[: self.n], -np.inf)
        weights = [table[p] for p in pieces]
        weights[0] = np.where(pieces[0] < 0, spelt, weights[0])
        alpha = np.full((n, width + 1), -np.inf)
        alpha[:, 0] = 0
        for j in range(1, width + 1):
            terms = np.stack([alpha[:, j - k - 1] + weights[k][:, j - k - 1] for k in range(min(j, len(weights)))], 1)
            top = terms.max(1)
            alpha[:, j] = top + np.log(np.exp(terms - top[:, None]).sum(1))
        total = alpha[np.arange(n), size]
        if counts is not None:
            beta = np.full((n, width + 1), -np.inf)
            beta[np.arange(n), size] = 0
            for i in range(width - 1, -1, -1):
                terms = np.stack([beta[:, i + k + 1] + weights[k][:, i] for k in range(min(width - i, len(weights)))], 1)
                top = np.maximum(terms.max(1), beta[:, i])
                top = np.where(np.isfinite(top), top, 0.0)
                sums = np.exp(terms - top[:, None]).sum(1) + np.exp(beta[:, i] - top)
                beta[:, i] = np.where(sums > 0, top + np.log(np.maximum(sums, 1e-300)), -np.inf)
            for k, found in enumerate(pieces):
                use = np.exp(alpha[:, : width - k] + weights[k] + beta[:, k + 1 :] - total[:, None])
                use[~inside[:, k:]] = 0
                known = found >= 0
                counts[: self.n] += np.bincount(found[known], use[known], self.n)
                if k == 0:
                    for c, v in zip(chars[inside & ~known].tolist(), use[inside & ~known].tolist()):
                        for b in chr(c).encode("utf-8", "replace"):
                            counts[self.n + b] += v
        return total

    def bytes_of(self, chars, wanted):
        """Log-probability of spelling a character with bytes, where ``wanted``."""
        out = np.zeros(chars.shape)
        some = chars[wanted]
        different, place = np.unique(some, return_inverse=True)
        cost = [sum(self.scores[self.n + b] for b in chr(int(c)).encode("utf-8", "replace")) for c in different]
        out[wanted] = np.array(cost)[place] if len(cost) else 0
        return out

    def long(self, word, counts):
        """The same sum for one long word, one character after the other; ``counts`` as in ``log_probabilities``."""
        text, alpha = MARK + word, array("d", [0.0])
        for j in range(1, len(text) + 1):
            terms = [alpha[j - k] + weight for k, weight, _ in self.pieces_at(text, j)]
            top = max(terms)
            alpha.append(top + math.log(sum(math.exp(t - top) for t in terms)))
        total = alpha[-1]
        if counts is not None:
            # beta[j]: logarithm of the sum over all ways to end from j on; only the last few are held.
            beta = {len(text): 0.0}
            ahead = {}
            for j in range(len(text), 0, -1):
                if j < len(text):
                    terms = ahead.pop(j, None)
                    if terms is None:
                        continue
                    top = max(terms)
                    beta[j] = top + math.log(sum(math.exp(t - top) for t in terms))
                for k, weight, uses in self.pieces_at(text, j):
                    ahead.setdefault(j - k, []).append(beta[j] + weight)
                    share = math.exp(alpha[j - k] + weight + beta[j] - total)
                    for i in uses:
                        counts[i] += share
                del beta[j]
        return total

    def pieces_at(self, text, end):
        """(length, score, entries used) of each subword that ends at a place; bytes spell a character that is none."""
        for k in range(1, min(end, self.longest) + 1):
            found = self.ids.get(text[end - k : end])
            if found is not None:
                yield k, self.scores[found], (found,)
            elif k == 1:
                spelt = [self.n + b for b in text[end - 1].encode("utf-8", "replace")]
                yield k, sum(self.scores[i] for i in spelt), spelt


def words_of(text):
    """Words after lower-casing A-Z, as bytes; the white space of the contract is that of bytes."""
    return text.encode().lower().split() if text else []


def count_words(texts):
    """(word, n) of one column of texts; the empty word counts the ends."""

    def run(batches):
        counts = {}

        def flush():
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )
            counts.clear()

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                for w in words_of(text):
                    counts[w] = counts.get(w, 0) + 1
                counts[b""] = counts.get(b"", 0) + 1
            if len(counts) >= FLUSH:
                yield from flush()
        if counts:
            yield from flush()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_subwords(counts, pieces, scores, passes=PASSES):
    """Scores fitted on the distinct training words: each counts once, as spelling is for new words."""
    words = counts.where("word <> ''").select("word")
    for _ in range(passes):
        shared = words.sparkSession.sparkContext.broadcast((pieces, scores))

        def run(batches, shared=shared):
            lattice = Lattice(*shared.value)
            uses = np.zeros(lattice.n + 256)
            for batch in slices(batches, 8_192):
                lattice.log_probabilities(batch.column(0).to_pylist(), uses)
            some = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array((uses[some] * _UNIT).astype(np.int64))], names=["piece", "uses"]
            )

        found = words.mapInArrow(run, "piece long, uses long").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        fitted = np.full(len(pieces) + 256, FLOOR)
        for r in found:
            fitted[r["piece"]] += r["uses"] / _UNIT
        scores = np.log(fitted / fitted.sum())
        shared.unpersist()
    return scores


def frequent_words(counts, most):
    """The most frequent words with their counts, at most so many.

    Words are counted by the size of their count, an eighth of an octave each, to find the size from which on
    they are few enough; so no task sends more than its share of them.
    """
    words = counts.where("word <> ''").withColumn("size", F.floor(F.log2("n") * 8).cast("int"))
    least, total = None, 0
    for r in words.groupBy("size").agg(F.count("*").alias("k")).orderBy(F.desc("size")).collect():
        total += r["k"]
        if total > most:
            break
        least = r["size"]
    return [] if least is None else words.where(F.col("size") >= least).select("word", "n").collect()


def score_documents(df, id_col="doc_id", text_col="text", fold=(7, 2), path=None, head=HEAD, passes=PASSES):
    """Base and model log10 probability of each row of ``df``; learns from the rows outside the fold.

    Null and empty texts are their end alone.  Rows are told apart by their place: null and repeated ids give a
    row each, and null ids are in no fold, so they are learnt from.  With nothing to learn from, the base has
    N = V = 0 and the model spells every word with the vocabulary's own scores and ends for nothing.  Extra
    columns are left out.
    """
    spark = df.sparkSession
    folder = workspace(spark)
    held_out = is_in_fold(id_col, *fold) if fold else F.lit(False)
    counts = stored(count_words(df.where(~held_out).select(text_col)), folder, "counts")
    total = counts.agg(
        F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when((F.col("n") == 1) & (F.col("word") != ""), 1)).alias("once")
    ).first()
    n, v = total["n"] or 0, total["v"]
    # Share of tokens that are spelt: words seen once are what new words are like.
    new = ((total["once"] or 0) + 1) / (n + 2)
    pieces, scores = load_vocabulary(path or public_tokenizers.path("piece_bpe_32k.model"))
    if v > 1:
        scores = fit_subwords(counts, pieces, scores, passes)
    top = frequent_words(counts, head)
    ends = (counts.where("word = ''").first() or {"n": 0})["n"]
    log10 = lambda p: math.log10(p) if p > 0 else 0.0
    below = log10(n + v + 1)
    end = (log10(ends + 1) - below, log10((1 - new) * ends / n) if n else 0.0, int(ends > 0))
    model = {"pieces": pieces, "scores": scores, "words": [r["word"] for r in top], "n": np.array([r["n"] for r in top], float), "end": end}
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        lattice = Lattice(model["pieces"], model["scores"])
        place = {w.encode(): i for i, w in enumerate(model["words"])}
        base = np.log10(model["n"] + 1) - below
        # exp of the spelling's logarithm vanishes for long words, where it adds nothing to a known one.
        spelt = lattice.log_probabilities(model["words"]) if place else np.zeros(0)
        full = np.log10((1 - new) * model["n"] / max(n, 1) + new * np.exp(spelt))
        for batch in slices(batches):
            rows, rest = [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                known, other = [], {}
                for w in words:
                    i = place.get(w)
                    if i is None:
                        other[w] = other.get(w, 0) + 1
                    else:
                        known.append(i)
                at = np.array(known, np.int64)
                rows.append((len(words) + 1, len(known) + end[2], float(base[at].sum()) + end[0], float(full[at].sum()) + end[1]))
                rest.append(other)
            unseen = [w.decode() for w in dict.fromkeys(w for other in rest for w in other)]
            cost = dict(zip(unseen, (lattice.log_probabilities(unseen) / math.log(10)).astype(np.float32).tolist()))
            tail = [[{"word": (t := w.decode()), "k": k, "spelt": cost[t]} for w, k in other.items()] for other in rest]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3),
                 *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.float64()))),
                 pa.array(tail, pa.list_(pa.struct([("word", pa.string()), ("k", pa.int32()), ("spelt", pa.float32())])))],
                names=["row", "id", "held_out", "n_tokens", "n_known", "base", "full", "tail"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    done = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_col, held_out.alias("held_out")).mapInArrow(
        run,
        f"row long, id {id_type}, held_out boolean, n_tokens long, n_known long, base double, full double, "
        "tail array<struct<word:string,k:int,spelt:float>>",
    )
    done = stored(done, folder, "documents")
    tail = done.select("row", F.inline("tail")).join(counts.where("word <> ''"), "word", "left")
    spelt = F.log10(F.lit(new)) + F.col("spelt").cast("double")
    word = F.log10(F.lit(1 - new) * F.col("n") / F.lit(max(n, 1)))
    larger = F.greatest(spelt, word)
    both = larger + F.log10(F.pow(F.lit(10.0), spelt - larger) + F.pow(F.lit(10.0), word - larger))
    sums = tail.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("known2"),
        F.sum(F.col("k") * (F.log10(F.coalesce("n", F.lit(0)) + F.lit(1.0)) - F.lit(below))).alias("base2"),
        F.sum(F.col("k") * F.when(F.col("n").isNull(), spelt).otherwise(both)).alias("full2"),
    )
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return done.drop("tail").join(sums, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        plus("n_known", "known2").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        plus("base", "base2").alias("base_score"),
        plus("full", "full2").alias("score"),
    )


ship(__name__)
