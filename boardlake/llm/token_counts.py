"""Token counts of sections by offset-mapped attribution (operator 9).

A document is encoded once, as a whole.  Its tokens have byte spans, its sections (lines,
each with its line feed) have byte spans, and both are sorted, so an interval join is a
search of token bounds among section bounds.  A token inside one section counts there.  The
rule for a token that crosses bounds: it counts in the section that holds most of its bytes,
of equals in the first.  So each token counts once, and the counts of a document's sections
sum to its tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.words import chunks

_BUILT: dict[tuple, tuple] = {}


def _encoder(content: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    key = hash(content), pattern
    if key not in _BUILT:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for label, rank in ranks.items():
            size[rank] = len(label)
        _BUILT.clear()
        _BUILT[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size
    return _BUILT[key]


def attribute(token_ends: np.ndarray, section_ends: np.ndarray) -> np.ndarray:
    """Section of every token; both given by the sorted ends of adjoining spans from zero."""
    starts = np.concatenate(([0], token_ends[:-1]))
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends, "left")
    out = first.copy()
    for t in np.flatnonzero(first != last):
        a, b = int(first[t]), int(last[t])
        cuts = np.concatenate(([starts[t]], section_ends[a:b], [token_ends[t]]))
        out[t] = a + int(np.argmax(np.diff(cuts)))
    return out


def section_tokens(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, section, char_start, char_end, n_tokens), one row per line of every document.

    ``path`` is a rank file on the driver, whose fixed couple of megabytes go to the tasks;
    ``pattern`` cuts text before the merges.  Special strings in a text are ordinary text.
    Sections are numbered from 0; spans are in code points and include the line feed.  A null
    or empty text is one empty section without tokens.  Repeated rows and null ids keep their
    own sections; an empty table gives an empty result; other columns are ignored.
    """
    with open(path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = _encoder(content.value, pattern)
        for batch in batches:
            base = 0
            for texts in chunks(x.as_py() for x in batch.column(1)):
                ids = [encoder.encode_to_numpy(t, disallowed_special=()) for t in texts]
                raw = [t.encode() for t in texts]
                data = np.frombuffer(b"".join(raw), np.uint8)
                doc_ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
                feeds = np.flatnonzero(data == 10) + 1
                ends = np.sort(np.concatenate((feeds, doc_ends)))  # a text that ends in a feed has an empty last line
                token_ends = np.cumsum(size[np.concatenate(ids).astype(np.int64)]) if len(data) else np.zeros(0, np.int64)
                counts = np.bincount(attribute(token_ends, ends), minlength=len(ends)) if len(token_ends) else np.zeros(len(ends), np.int64)
                # the k-th bound of a document closes its k-th section
                n_sections = np.fromiter((t.count("\n") + 1 for t in texts), np.int64, len(texts))
                of = np.repeat(np.arange(len(texts)), n_sections)
                head = np.cumsum(n_sections) - n_sections
                section = np.arange(len(ends)) - head[of]
                chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                char_end = chars[ends]
                char_start = np.concatenate(([0], char_end[:-1]))
                zero = char_start[head][of]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of + base)), pa.array(section), pa.array(char_start - zero), pa.array(char_end - zero), pa.array(counts)],
                    ["id", "section", "char_start", "char_end", "n_tokens"],
                )
                base += len(texts)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, section long, char_start long, char_end long, n_tokens long").withColumnRenamed("id", id_col)
