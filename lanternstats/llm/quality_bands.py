"""Quality rules: compression bands.

Repetitive text compresses too well, random text hardly at all.  The zstandard ratio (bytes before by bytes
after) of the whole document, and of every fixed chunk, must lie in a band.  What a text of natural language
reaches depends on its length, so each length has limits of its own.
"""

import numpy as np
import pyarrow as pa
import zstandard

from lanternstats.llm.common import ship, slices

#: (up to so many bytes, least ratio, most ratio) of a whole document.
WHOLE_BANDS = (
    (256, 0.85, 3.5),
    (1_024, 1.15, 4.0),
    (4_096, 1.4, 4.5),
    (16_384, 1.6, 5.0),
    (65_536, 1.7, 5.5),
    (float("inf"), 1.8, 6.0),
)
#: The same for chunks.
CHUNK_BYTES = 4_096
CHUNK_BANDS = ((512, 0.85, 4.0), (1_024, 1.15, 4.0), (float("inf"), 1.4, 4.5))
#: (up to so many chunks, share): a document fails when more than this share of its chunks do.  One bad chunk of two
#: is too much; of many chunks about a sixth.
CHUNK_SHARES = ((2, 0.4), (8, 0.25), (float("inf"), 0.15))
LEVEL = 3

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_bytes long, ratio double, n_chunks long, n_bad_chunks long, verdict string, kept boolean"
)
_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words):
    """Words inside a window of three that occurs at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    pairs = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
    windows = pairs[:-1].astype(np.int64) * len(ids) + w[2:]
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[place] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k : n - 2 + k] |= again
    return int(hit.sum())


def repeated_lines(raw):
    """Lines with a word which equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def in_band(size, ratio, bands):
    low, high = next((lo, hi) for most, lo, hi in bands if size <= most)
    return "incompressible" if ratio < low else "repetitive" if ratio > high else None


def judge(raw, compressor, whole_bands, chunk_bytes, chunk_bands, chunk_shares):
    """Ratio, number of chunks, number of bad chunks and verdict of one text."""
    if not raw:
        return 0.0, 0, 0, "empty"
    ratio = len(raw) / len(compressor.compress(raw))
    chunks = [raw[i : i + chunk_bytes] for i in range(0, len(raw), chunk_bytes)]
    if len(chunks) > 1 and len(chunks[-1]) < chunk_bytes // 2:  # too short a rest says little
        chunks[-2:] = [chunks[-2] + chunks[-1]]
    bad = [in_band(len(x), len(x) / len(compressor.compress(x)), chunk_bands) for x in chunks]
    n_bad = sum(x is not None for x in bad)
    verdict = in_band(len(raw), ratio, whole_bands)
    share = next(share for most, share in chunk_shares if len(chunks) <= most)
    if verdict is None and n_bad > share * len(chunks):
        verdict = "chunks " + ("repetitive" if 2 * bad.count("repetitive") >= n_bad else "incompressible")
    return ratio, len(chunks), n_bad, verdict or "ok"


def compression_bands(
    df,
    id_col="doc_id",
    text_col="text",
    whole_bands=WHOLE_BANDS,
    chunk_bytes=CHUNK_BYTES,
    chunk_bands=CHUNK_BANDS,
    chunk_shares=CHUNK_SHARES,
    level=LEVEL,
):
    """Counts, ratios and the verdict of each row of ``df``.

    A row is kept if it passes the plain rules (50 words, at most half of them in repeated windows) and the
    bands.  Null and empty texts have no words and fail.  Texts of any length are compressed whole and in all
    their chunks.  Each row is judged alone, so null ids, repeated rows
    and extra columns change nothing; other columns than the id are left out.  An empty table gives no rows.
    """

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=level)
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                raw = text.encode()
                words = raw.split()
                n, repeat = len(words), repeated_words(words)
                failed = n < 50 or 100 * repeat > 50 * n
                ratio, chunks, bad, verdict = judge(raw, compressor, whole_bands, chunk_bytes, chunk_bands, chunk_shares)
                rows.append(
                    (n, len(text) - sum(map(raw.count, _SPACE_BYTES)), sum(map(raw.count, _SYMBOL_BYTES)),
                     repeated_lines(raw), repeat, failed, len(raw), ratio, chunks, bad, verdict,
                     not failed and verdict == "ok")
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), _TYPES))], names=[id_col, *_NAMES]
            )

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, {COLUMNS}")


_SPACE_BYTES = [bytes([c]) for c in _SPACES]
_SYMBOL_BYTES = [bytes([c]) for c in _SYMBOLS]
_NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
_TYPES = [{"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}[c.split()[1]] for c in COLUMNS.split(", ")]

ship(__name__)
