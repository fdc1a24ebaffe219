"""Token counts: rank-synchronous array merging.

Pre-tokens of a batch lie in one ragged numpy array of byte symbols.  In every round each pre-token finds its
lowest-ranked pair of neighbours and merges all of that pair's places at once; pre-tokens with no pair left
drop out.  What survives is counted.  A pre-token is merged once and its count remembered.
"""

import json

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex

from lanternstats.llm.common import ship, slices

#: Remembered pre-tokens of a task; beyond that it starts anew.
CACHE = 400_000
NO_RANK = np.int64(1) << 40


def byte_symbols():
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 bytes stand for themselves, the others follow from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, spare = {b: chr(b) for b in printable}, 0
    for b in range(256):
        if b not in names:
            names[b] = chr(256 + spare)
            spare += 1
    return [names[b] for b in range(256)]


def load_merges(path):
    """Symbol of each byte; sorted keys of mergeable pairs with their ranks and results; special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    pairs = [x if isinstance(x, list) else x.split(" ") for x in spec["model"]["merges"]]
    key = np.array([vocab[a] * len(vocab) + vocab[b] for a, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int64)
    order = np.argsort(key, kind="stable")
    return {
        "first": np.array([vocab[c] for c in byte_symbols()], np.int64),
        "base": len(vocab),
        "key": key[order],
        "rank": order.astype(np.int64),
        "made": made[order],
        "special": [x["content"] for x in spec["added_tokens"]],
    }


def merge_all(pre_tokens, merges):
    """Number of symbols left of each of ``pre_tokens`` (bytes, not empty)."""
    counts = np.ones(len(pre_tokens), np.int64)
    length = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
    symbols = merges["first"][np.frombuffer(b"".join(pre_tokens), np.uint8)]
    owner = np.repeat(np.arange(len(pre_tokens)), length)
    key, rank, made, base = merges["key"], merges["rank"], merges["made"], merges["base"]
    while len(symbols):
        pair = symbols[:-1] * base + symbols[1:]
        place = np.searchsorted(key, pair)
        place[place == len(key)] = 0
        known = (key[place] == pair) & (owner[:-1] == owner[1:])
        ranks = np.append(np.where(known, rank[place], NO_RANK), NO_RANK)
        start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        size = np.diff(np.append(start, len(owner)))
        least = np.minimum.reduceat(ranks, start)
        done = least == NO_RANK
        counts[owner[start[done]]] = size[done]
        merge = (ranks == np.repeat(least, size)) & (ranks < NO_RANK)
        # In a run of overlapping places (a pair of equal symbols) every second one is merged, from the left.
        at = np.flatnonzero(merge)
        fresh = np.append(True, np.diff(at) > 1)[: len(at)]
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - begin) % 2 == 0]
        symbols = symbols.copy()
        symbols[at] = made[place[at]]
        stay = np.repeat(~done, size)
        stay[at + 1] = False
        symbols, owner = symbols[stay], owner[stay]
    return counts


def token_counts(df, id_col="doc_id", text_col="text", path=None, limit=512):
    """Bytes and tokens of each row of ``df``, and whether the tokens exceed ``limit``.

    The vocabulary is read where the query is built and sent along; it has a fixed size.  A special string in
    a text is one token.  Null and empty texts have no bytes and no tokens.  Each row is counted alone: null
    ids and repeated rows are returned as they are, other columns are left out.
    """
    merges = load_merges(path or public_tokenizers.path("byte_bpe_50k.json"))
    shared = df.sparkSession.sparkContext.broadcast(merges)
    pattern, special = public_tokenizers.PATTERN, merges["special"]

    def run(batches):
        find = regex.compile(pattern).findall
        cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))).split if special else None
        seen = {}
        for batch in slices(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            found, extra = [], []
            for text in texts:
                parts = cut(text) if cut else [text]
                extra.append(len(parts) - 1)
                tokens = find(parts[0])
                for part in parts[1:]:
                    tokens += find(part)
                found.append(tokens)
            new = set().union(*found)
            if len(seen) + len(new) > CACHE:
                seen.clear()
            new = [x for x in new if x not in seen]
            if new:
                seen.update(zip(new, merge_all([x.encode() for x in new], shared.value).tolist()))
            tokens = [more + sum(map(seen.__getitem__, x)) for x, more in zip(found, extra)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x.encode()) for x in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([x > limit for x in tokens], pa.bool_()),
                ],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")


ship(__name__)
