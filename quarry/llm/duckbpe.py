"""Byte-level BPE inside one Python worker, stated as DuckDB queries.

The vocabulary becomes two tables: ``merges(l, r, rank, safe)``, one row for every way a
token splits into two tokens, and ``vocab(id, piece)``. :class:`DuckBPE` encodes
words with a recursive query over token-position rows and decodes id lists with an ordered
aggregation. Spark partitions the documents; nothing here knows about Spark.
"""

from __future__ import annotations

import base64
import functools

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Rows are (word, pos, stop, id): token `id` covers the bytes pos..stop of the batch's joined
# words. Between two words one place is free, so the right neighbour of a row is the row whose pos
# equals its stop.
# Each step contracts every unfinished word's leftmost pair of smallest rank, in one number
# (rank, then pos), until no pair of the word is a token.
ENCODE = """
WITH RECURSIVE live(step, word, pos, stop, id) AS (
    SELECT 0, word, pos, pos + 1, id FROM seed
  UNION ALL
    (WITH pair AS (
        SELECT a.word, m.rank::BIGINT << 32 | a.pos AS best, a.stop AS mid, b.stop
        FROM live a JOIN live b ON b.pos = a.stop
        JOIN merges m ON m.l = a.id AND m.r = b.id
     ), chosen AS (
        SELECT word, min(best) AS best, arg_min(mid, best) AS mid, arg_min(stop, best) AS stop
        FROM pair GROUP BY word
     )
     SELECT t.step + 1, t.word, t.pos,
            CASE WHEN t.pos = c.best & 4294967295 THEN c.stop ELSE t.stop END,
            CASE WHEN t.pos = c.best & 4294967295 THEN (c.best >> 32)::INTEGER ELSE t.id END
     FROM live t JOIN chosen c ON c.word = t.word
     WHERE t.pos <> c.mid)
)
SELECT word, id FROM live JOIN (SELECT word, max(step) AS step FROM live GROUP BY word) USING (word, step)
ORDER BY word, pos
"""

# For long words, many steps of one pair each would be quadratic. The next non-overlapping pairs
# of the same rank would follow anyway until a fresh token makes a lower-ranked pair with a
# neighbour, so all up to the first such place (`brake`) go in the same step; `safe` marks
# tokens that never make one. The state is one row per position, replaced by its step's result
# (id -1: contracted away), so that a word takes memory for its bytes, not for its steps.
ENCODE_LONG = """
WITH RECURSIVE live(pos, word, stop, id) USING KEY (pos) AS (
    SELECT pos, word, pos + 1, id FROM seed
  UNION
    (WITH now AS (
        SELECT * FROM recurring.live WHERE id >= 0
     ), pair AS (
        SELECT a.word, a.pos, a.stop AS mid, b.stop, m.rank, m.safe
        FROM now a JOIN now b ON b.pos = a.stop AND b.word = a.word
        JOIN merges m ON m.l = a.id AND m.r = b.id
     ), lowest AS (
        SELECT word, min(rank) AS rank FROM pair GROUP BY word
     ), hit AS (
        SELECT p.*, count(*) OVER (PARTITION BY p.word) AS n
        FROM pair p JOIN lowest USING (word, rank)
     ), several AS (
        SELECT *, coalesce(lag(mid) OVER w = pos, false) AS shares
        FROM hit WHERE n > 1 WINDOW w AS (PARTITION BY word ORDER BY pos)
     ), runs AS (
        SELECT *, sum(CASE WHEN shares THEN 0 ELSE 1 END)
                    OVER (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run
        FROM several
     ), parity AS (
        SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 AS odd FROM runs
     ), beside AS (
        SELECT word, pos, rank, rank AS l, rank AS r FROM parity WHERE NOT safe
        UNION ALL
        SELECT p.word, p.pos, p.rank, t.id, p.rank FROM parity p JOIN now t ON t.stop = p.pos AND t.word = p.word
        WHERE NOT p.safe
        UNION ALL
        SELECT p.word, p.pos, p.rank, p.rank, t.id FROM parity p JOIN now t ON t.pos = p.stop AND t.word = p.word
        WHERE NOT p.safe
     ), brake AS (
        SELECT b.word, min(b.pos) AS limit_pos FROM beside b JOIN merges m USING (l, r)
        WHERE m.rank < b.rank GROUP BY b.word
     ), chosen AS (
        SELECT word, pos, mid, stop, rank FROM hit WHERE n = 1
        UNION ALL
        SELECT word, pos, mid, stop, rank FROM parity LEFT JOIN brake USING (word)
        WHERE odd = 1 AND (limit_pos IS NULL OR pos <= limit_pos)
     )
     SELECT pos, word, stop, rank FROM chosen
     UNION ALL
     SELECT mid, word, mid, -1 FROM chosen)
)
SELECT word, id FROM live WHERE id >= 0 ORDER BY word, pos
"""

# One sort over all tokens; the pieces of a document then stand side by side.
DECODE = """
SELECT piece FROM tokens JOIN vocab USING (id) ORDER BY pos
"""

LONG_WORD = 64  # bytes


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in (ln.split() for ln in f if ln.strip())}


def merge_rows(ranks: dict[bytes, int]) -> pa.Table:
    """Every (left, right) pair of tokens whose joined bytes are a token, with that token's rank.

    ``safe``: no merge that uses the joined token has a lower rank than it.
    """
    left, right, rank = [], [], []
    for tok, k in ranks.items():
        for i in range(1, len(tok)):
            a, b = ranks.get(tok[:i]), ranks.get(tok[i:])
            if a is not None and b is not None:
                left.append(a), right.append(b), rank.append(k)
    unsafe = {part for a, b, k in zip(left, right, rank, strict=True) for part in (a, b) if k < part}
    return pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()),
                     "rank": pa.array(rank, pa.int32()),
                     "safe": pa.array([k not in unsafe for k in rank], pa.bool_())})


class DuckBPE:
    """Encoder and decoder over one in-memory DuckDB; one per worker process."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.known = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.known[list(ranks.values())] = True
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = merge_rows(ranks)  # noqa: F841  (read by name below)
        # one character per byte (U+0000..U+00FF), so that text aggregation joins bytes
        vocab = pa.table({"id": pa.array(ranks.values(), pa.int32()),  # noqa: F841
                          "piece": pa.array([t.decode("latin-1") for t in ranks], pa.string())})
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM vocab")

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word."""
        out: list = [None] * len(words)
        for query, chosen in ((ENCODE, [k for k, w in enumerate(words) if len(w) <= LONG_WORD]),
                              (ENCODE_LONG, [k for k, w in enumerate(words) if len(w) > LONG_WORD])):
            for k, ids in zip(chosen, self._encode([words[k] for k in chosen], query), strict=True):
                out[k] = ids
        return out

    def packed(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word as little-endian int32, without an array for each."""
        out: list = [b""] * len(words)
        for query, chosen in ((ENCODE, [k for k, w in enumerate(words) if len(w) <= LONG_WORD]),
                              (ENCODE_LONG, [k for k, w in enumerate(words) if len(w) > LONG_WORD])):
            if chosen:
                ids, ends = self._ids([words[k] for k in chosen], query)
                data, ends = ids.astype("<i4", copy=False).tobytes(), (4 * ends).tolist()
                for k, start, end in zip(chosen, [0, *ends], ends):  # noqa: B905  (one start more)
                    out[k] = data[start:end]
        return out

    def _encode(self, words: list[bytes], query: str) -> list[np.ndarray]:
        if not words:
            return []
        ids, ends = self._ids(words, query)
        return np.split(ids, ends[:-1])

    def _ids(self, words: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all words, where each word's end)."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        joined = np.frombuffer(b"".join(words), dtype=np.uint8)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        seed = pa.table({"word": word, "pos": np.arange(len(joined), dtype=np.int32) + word,  # noqa: F841
                         "id": self.byte_id[joined]})
        got = self.con.execute(query).fetchnumpy()
        counts = np.bincount(got["word"], minlength=len(words))
        return got["id"].astype(np.int32), np.cumsum(counts)

    def decode(self, ids: np.ndarray, doc: np.ndarray, n_docs: int) -> list[bytes]:
        """The bytes of each document, from its ids in order; ``doc`` numbers the documents, ascending."""
        if not len(ids):
            return [b""] * n_docs
        tokens = pa.table({"pos": np.arange(len(ids), dtype=np.int32), "id": ids})  # noqa: F841
        if ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all():
            raise ValueError("an id is not in the vocabulary")
        pieces = self.con.sql(DECODE).to_arrow_table()["piece"].combine_chunks()
        starts = pa.array(np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32))
        joined = pc.binary_join(pa.ListArray.from_arrays(starts, pieces), "")
        return [piece.encode("latin-1") for piece in joined.to_pylist()]


@functools.lru_cache(maxsize=2)
def worker(path: str) -> DuckBPE:
    """The worker process's own instance; kept between tasks."""
    return DuckBPE(path)
