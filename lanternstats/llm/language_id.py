"""Language identification: cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A document is cut, from the left, into the
longest pieces that occur in that text; a language that needs few such phrases fits.  A phrase costs the
logarithm of the length of the text that it is found in, so a language's cost is a code length, and the
smallest wins.  Many documents are parsed at once: a step moves all of them on by one letter in a numpy table.
"""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanternstats.llm.common import is_in_fold, ship, slices

#: Bounds of what is learnt from: documents per language, letters (with gaps) per language.
SAMPLE_DOCS = 64
TRAIN_LETTERS = 24_000
#: A document that is longer than its share gives stretches of about so many letters from all over its text.
SAMPLE_STRETCH = 128
#: A document is parsed in stretches of so many letters; a phrase ends where a stretch ends.
STRETCH = 2_048
_GAP, _RARE = 0, 1
_SALTS = 16
_NO_LETTERS = re.compile(r"[\W\d_]+")


def code_table(alphabet):
    """Code of every character: 0 for what is no letter, from 2 on those of ``alphabet``, 1 for other letters."""
    codes = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.int32, 0x110000)
    codes[[ord(c) for c in alphabet]] = np.arange(2, 2 + len(alphabet))
    return codes


def encode(text, codes):
    """Letters of a text as codes; anything between words is one gap."""
    out = codes[np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)]
    keep = out != _GAP
    keep[1:] |= out[:-1] != _GAP
    return out[keep]


def letters_of(text):
    """Lower-cased words of a text with one gap between."""
    return _NO_LETTERS.sub(" ", text.lower()).strip()


def shares(lengths, bound=TRAIN_LETTERS):
    """Letters to take of texts of these lengths: all of the short ones, what they leave goes to the longer ones."""
    out, left = [0] * len(lengths), bound
    for k, i in enumerate(sorted(range(len(lengths)), key=lambda i: lengths[i])):
        # A gap follows each text.
        out[i] = max(min(lengths[i], left // (len(lengths) - k) - 1), 0)
        left -= out[i] + (out[i] > 0)
    return out


def spread(text, share):
    """At most ``share`` letters of ``letters_of`` a text: the whole, or a stretch of each of equal parts of it.

    Where in its part a stretch begins is chosen by a hash of the text.
    """
    if len(text) <= share:
        return text
    if share <= 0:
        return ""
    parts = -(-share // SAMPLE_STRETCH)
    size, seed, out = (share - parts + 1) // parts, zlib.crc32(text.encode("utf-8", "replace")), []
    for k in range(parts):
        low, high = len(text) * k // parts, len(text) * (k + 1) // parts - size
        at = low + zlib.crc32(k.to_bytes(8, "big"), seed) % max(high - low + 1, 1)
        out.append(text[at : at + size])
    return " ".join(out)


def suffix_automaton(letters):
    """Transitions of the automaton of all substrings of ``letters``: a list of {letter: state}."""
    step, link, size, last = [{}], [-1], [0], 0
    for c in letters:
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


def parse_table(letters, width):
    """Tables of what a letter does in a state: (entries, restarts).

    A state is a place in the entries, the root 0; its transition of a letter lies as many places further on,
    where no other state has one.  An entry holds the state that it belongs to and the next one.  A letter that
    does not go on ends the phrase and begins the next, at the restart's state; one that the text lacks is a
    phrase itself.  So the size follows from the text, not from the number of letters.
    """
    steps = suffix_automaton(letters.tolist())
    base, free = np.full(len(steps), -1, np.int64), np.ones(2 * sum(map(len, steps)) + 2 * width, bool)
    bases = np.zeros(len(free), bool)
    order = sorted(range(1, len(steps)), key=lambda s: -len(steps[s]))
    base[0], bases[0] = 0, True
    free[list(steps[0])] = False
    low = 0
    for state in order:
        if len(steps[state]) < 2:
            break
        of = np.sort(np.fromiter(steps[state], np.int64, len(steps[state])))
        low += int(free[low:].argmax())
        at, far = max(low - int(of[0]), 0), 64
        while True:
            if at + far + width > len(free):
                free = np.append(free, np.ones(len(free), bool))
                bases = np.append(bases, np.zeros(len(bases), bool))
            fits = ~bases[at : at + far]
            for c in of:
                fits &= free[at + c : at + c + far]
            if fits.any():
                break
            at, far = at + far, 2 * far
        base[state] = at + int(fits.argmax())
        bases[base[state]] = True
        free[base[state] + of] = False
    # States of one transition or none: whatever places are left.
    few = [s for s in order if base[s] < 0]
    taken, vacant = bases.tolist(), iter(np.flatnonzero(free).tolist())
    end = len(taken)
    for state in few:
        place = None
        for c in steps[state]:
            for v in vacant:
                if v >= c and not taken[v - c]:
                    place = v - c
                    break
        if place is None:
            place, end = end, end + width
        if place < len(taken):
            taken[place] = True
        base[state] = place
    source = np.repeat(base, list(map(len, steps)))
    letter = np.fromiter((c for step in steps for c in step), np.int64, len(source))
    target = base[np.fromiter((t for step in steps for t in step.values()), np.int64, len(source))]
    entries = np.full(int(base.max()) + width, -1, np.int64)
    entries[source + letter] = source << 32 | target
    known = entries[:width] >> 32 == 0
    restarts = np.where(known, (entries[:width] & 0xFFFFFFFF) << 2 | 1, 2)
    return entries, restarts


def learn(texts_by_language, train_letters=TRAIN_LETTERS):
    """The model: languages, all letters of their texts, parse tables and the cost of a phrase for each language."""
    chosen = {}
    for language, texts in texts_by_language.items():
        texts = [x for x in map(letters_of, texts) if x]
        chosen[language] = [spread(x, n) for x, n in zip(texts, shares(list(map(len, texts)), train_letters))]
    letters = sorted({c for texts in chosen.values() for text in texts for c in text if c.isalpha()})
    codes = code_table(letters)
    model = {"languages": [], "alphabet": letters, "tables": [], "cost": [], "width": len(letters) + 2}
    for language in sorted(chosen):
        parts = [x for x in (encode(t, codes) for t in chosen[language]) if len(x)]
        if not parts:
            continue
        joined = np.concatenate([np.append(x, _GAP) for x in parts])[:train_letters].astype(np.int64)
        model["languages"].append(language)
        model["tables"].append(parse_table(joined, model["width"]))
        model["cost"].append(float(np.log2(len(joined) + 1)))
    return model


def count_phrases(encoded, model, stretch=STRETCH):
    """Phrases of each encoded text in each language."""
    spans = [(i, a, min(a + stretch, len(x))) for i, x in enumerate(encoded) for a in range(0, len(x), stretch)]
    out = np.zeros((len(model["languages"]), len(encoded)), np.int64)
    if not spans:
        return out
    spans.sort(key=lambda s: s[1] - s[2])
    owner = np.array([s[0] for s in spans])
    size = np.array([s[2] - s[1] for s in spans])
    lanes = np.zeros((size[0], len(spans)), np.int32)
    for k, (i, a, b) in enumerate(spans):
        lanes[: b - a, k] = encoded[i][a:b]
    active = np.searchsorted(-size, -np.arange(size[0]), side="left")
    for row, (entries, restarts) in enumerate(model["tables"]):
        state, phrases = np.zeros(len(spans), np.int64), np.zeros(len(spans), np.int64)
        for j, k in enumerate(active):
            now, letter = state[:k], lanes[j, :k]
            found = entries[now + letter]
            again = restarts[letter]
            ends = found >> 32 != now
            # In the root no phrase is under way.
            phrases[:k] += ends * ((again & 3) - (now == 0))
            state[:k] = np.where(ends, again >> 2, found & 0xFFFFFFFF)
        phrases += state > 0
        np.add.at(out[row], owner, phrases)
    return out


def identify(texts, model, codes):
    """Predicted language and its probability, by code lengths, of each text."""
    encoded = [encode(t or "", codes) for t in texts]
    has_letter = [bool((x != _GAP).any()) for x in encoded]
    if not model["languages"]:
        return [("und", 0.0)] * len(texts)
    bits = count_phrases(encoded, model) * np.array(model["cost"])[:, None]
    best = bits.argmin(0)
    share = 1 / np.exp2(np.maximum(bits.min(0)[None, :] - bits, -1_000)).sum(0)
    return [(model["languages"][b], float(s)) if ok else ("und", 0.0) for b, s, ok in zip(best, share, has_letter)]


def training_texts(df, id_col, text_col, lang_col, fold, docs=SAMPLE_DOCS, train_letters=TRAIN_LETTERS):
    """Texts by language: of each language so many documents with the smallest hashes, outside the fold.

    The hashes are ranked within parts of a language, so no task sees all its documents.  The tasks first tell how
    long the texts are, then send each text's share of the letters, so that no whole long text is sent.
    """
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    if fold:
        rows = rows.where(~is_in_fold(id_col, *fold))
    keyed = rows.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(id_col).alias("h"))
    rank = F.row_number().over(Window.partitionBy("lang", F.pmod("h", F.lit(_SALTS))).orderBy("h", "id"))
    chosen = keyed.withColumn("rank", rank).where(F.col("rank") <= docs // _SALTS).select("id").collect()
    ids = sorted({r[0] for r in chosen})
    if not ids:
        return {}
    found = rows.where(F.col(id_col).isin(ids)).select(F.col(lang_col).cast("string"), F.col(id_col).cast("string"), text_col)

    def taken(share):
        def run(batches):
            for batch in slices(batches):
                out = []
                for language, i, text in zip(*(c.to_pylist() for c in batch.columns)):
                    text = letters_of(text)
                    out.append((language, i, len(text), spread(text, share.get((language, i, len(text)), 0))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64(), pa.string()))],
                    names=["lang", "id", "n", "text"],
                )

        return found.mapInArrow(run, "lang string, id string, n long, text string").where("n > 0").collect()

    sizes = {}
    for r in taken({}):
        sizes.setdefault(r["lang"], []).append((r["id"], r["n"]))
    share = {}
    for language, of in sizes.items():
        share |= {(language, *x): n for x, n in zip(of, shares([n for _, n in of], train_letters))}
    texts = {}
    for language, _, _, text in sorted(taken(share), key=lambda r: (r["id"], r["text"])):
        texts.setdefault(language, []).append(text)
    return texts


def language_id(df, id_col="doc_id", text_col="text", lang_col="lang", fold=(3, 1), labelled=None, labelled_id_col=None):
    """Fold, predicted language and score of each row of ``df``.

    Learns from ``labelled`` (``df`` itself if not given), rows of the fold left out.  ``und`` with score 0
    stands for null texts, texts without a letter, and everything if there is nothing to learn from.  Each row
    is judged alone; null ids are in no fold and are not learnt from; repeated rows are returned as often.
    Ties go to the language that is first by name.  Extra columns are left out.
    """
    model = learn(training_texts(labelled if labelled is not None else df, labelled_id_col or id_col, text_col, lang_col, fold))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        codes = code_table(model["alphabet"])
        for batch in slices(batches, 1_024):
            found = identify(batch.column(1).to_pylist(), model, codes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[id_col, "held_out", "lang_pred", "score"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    held_out = (is_in_fold(id_col, *fold) if fold else F.lit(False)).alias("held_out")
    return df.select(id_col, text_col, held_out).mapInArrow(
        run, f"`{id_col}` {id_type}, held_out boolean, lang_pred string, score double"
    )


ship(__name__)
