"""Token counts (operator 3) by overlap resynchronisation.

A document of at most ``chunk`` characters is counted piece by piece. A piece is a space
and what follows it up to the next such cut; a cut lies before a space that comes after a
character that is certainly not white space. The tokenizer's pattern never carries a match
from other text into white space and looks only ahead, so such a cut is a boundary of the whole text
and a piece's count does not depend on its surroundings. Piece counts are kept in a
bounded cache per Python worker, since words repeat.

A longer (huge) document is encoded in overlapping chunks with offsets. Within an overlap, a
common boundary is a place where a pre-token begins in both encodings, away from the edges
by more than the longest special string. The left chunk is right up to there (it began at a proven boundary
and what it read lies inside it), and from a place where a pre-token begins the pattern reads the
same on, so the right chunk is right from there. The chunks are spliced at the last such
place. Where there is none, the overlap is doubled, up to the rest of the document.

Defined cases: a NULL or empty text has 0 bytes and 0 tokens; special strings in a text are
handled as the library does by default; equal rows are counted each; NULL ids are allowed; an empty
table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import session

CHUNK, OVERLAP, CACHE = 32_768, 1_024, 400_000
_SUB_BATCH = 2 << 20  # characters whose pieces are held at a time

# A space after one of these is no safe cut: white space by any definition, or
# characters on which definitions differ.
_UNSAFE = re.compile("[\\s\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff] ")
_tokenizers: dict[str, Counter] = {}


class Counter:
    """Token counts of texts by one tokenizer file, with a bounded cache of piece counts."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.chunk, self.overlap = chunk, overlap
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.margin = 1 + max([1, *map(len, added)])
        self.cache: dict[str, int] = {}

    @staticmethod
    def pieces(text: str) -> list[str]:
        parts = text.split(" ")
        out = [parts[0], *[" " + p for p in parts[1:]]]
        if not _UNSAFE.search(text) and not text.startswith(" "):
            return out
        safe = [out[0]]
        for p in out[1:]:
            if safe[-1] == "" or _UNSAFE.search(safe[-1][-1] + " "):
                safe[-1] += p
            else:
                safe.append(p)
        return safe

    def _encode(self, texts: list[str]):
        return self.tok.encode_batch_fast(texts, add_special_tokens=False)

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        at = 0
        while at < len(texts):
            held, pieces = 0, []
            first = at
            while at < len(texts) and held < _SUB_BATCH:
                t = texts[at]
                held += len(t)
                pieces.append(self.pieces(t) if len(t) <= self.chunk else None)
                at += 1
            cache = self.cache
            missing = list(set().union(*(p for p in pieces if p is not None)).difference(cache))
            if len(cache) + len(missing) > CACHE:
                kept = set().union(*(p for p in pieces if p is not None))
                cache = self.cache = {k: v for k, v in cache.items() if k in kept}
            for i in range(0, len(missing), 4096):
                part = missing[i:i + 4096]
                cache.update(zip(part, map(len, self._encode(part)), strict=True))
            get = cache.__getitem__
            for k, p in enumerate(pieces):
                out[first + k] = sum(map(get, p)) if p is not None else self.huge(texts[first + k])
        return out

    def _chunk(self, text: str, a: int, b: int):
        """(text position of each token's start, positions where a pre-token begins) of text[a:b]."""
        enc = self.tok.encode(text[a:b], add_special_tokens=False)
        starts, heads, last = [], [], object()
        # A special token has no pre-token number of its own in every version; its start is a head.
        for (s, _), w in zip(enc.offsets, enc.word_ids, strict=True):
            starts.append(a + s)
            if w is None or w != last:
                heads.append(a + s)
            last = w
        return starts, heads

    def huge(self, text: str) -> int:
        """Tokens of a long text, from overlapping chunks spliced at proven boundaries."""
        n, total, a, at = len(text), 0, 0, 0  # a: where the left chunk begins; at: proven boundary it counts from
        overlap = self.overlap
        end = min(n, self.chunk + overlap)
        starts, heads = self._chunk(text, a, end)
        while end < n:
            begin = end - overlap
            stop = min(n, end + self.chunk)
            right, right_heads = self._chunk(text, begin, stop)
            # The left chunk's last pre-token may be cut short, but its start is certain.
            lo, hi = begin + self.margin, min(end - self.margin, heads[-1])
            places = [p for p in set(heads).intersection(right_heads) if lo <= p <= hi]
            if not places:  # widen: read the left chunk further, from its own start
                overlap *= 2
                end = min(n, begin + overlap)
                starts, heads = self._chunk(text, a, end)
                continue
            p = max(places)
            total += bisect.bisect_left(starts, p) - bisect.bisect_left(starts, at)
            a, at, end, overlap = begin, p, stop, self.overlap
            starts, heads = right, right_heads
        return total + len(starts) - bisect.bisect_left(starts, at)


def counter(path: str, **sizes) -> Counter:
    """The worker's counter for one tokenizer file (loaded once)."""
    key = f"{path}:{sorted(sizes.items())}"
    if key not in _tokenizers:
        _tokenizers[key] = Counter(path, **sizes)
    return _tokenizers[key]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit). ``tokenizer``: path of a tokenizer .json that every
    worker can read."""
    session(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer, chunk=chunk, overlap=overlap)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            n = pa.array(c.counts(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
