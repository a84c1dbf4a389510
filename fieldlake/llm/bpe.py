"""Byte-level BPE: DuckDB queries per partition encode the distinct words and decode the ids.

Rows of (word, position, token) meet the merge table, and every word contracts its leftmost
pair of least rank in each step of a recursive query, until no word has a pair left. A text
is its words' ids one after another; ids are decoded by an ordered aggregation.

No query holds more than a fixed number of bytes, words or ids, however long a word or a text
is: a very long word is contracted in windows that are joined where two tokens stay apart when
encoded together, which is what makes a row of tokens the encoding of its bytes.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import documents, lean, prepare, text_slices
from fieldlake.llm.registry import query

#: Text per step of a task, words per recursive query, bytes of words kept with their ids, ids decoded at once.
SLICE_BYTES = 2 << 20
WORDS_PER_QUERY = 20_000
KEPT_BYTES = 24 << 20
IDS_PER_QUERY = 300_000
#: A longer word contracts many pairs of its least rank in a step, in windows of so many bytes.
LONG_WORD = 256
WINDOW = 1 << 16
#: Matches of the pattern that a task looks up at once.
MATCHES_AT_ONCE = 400_000


_ENCODE = """
WITH RECURSIVE state(word, pos, tok, step) AS (
    SELECT word, pos, tok, 0 FROM start
    UNION ALL
    SELECT s.word, s.pos, CASE WHEN s.pos = b.spot THEN b.merged ELSE s.tok END, s.step + 1
    FROM state s JOIN (
        SELECT word, best & 4294967295 AS spot, best >> 32 AS merged, gone FROM (
            SELECT p.word, min(m.merged * 4294967296 + p.pos) AS best,
                   arg_min(p.next_pos, m.merged * 4294967296 + p.pos) AS gone
            FROM (SELECT word, pos, tok, lead(tok) OVER w AS next_tok, lead(pos) OVER w AS next_pos,
                         lead(word) OVER w AS next_word
                  FROM state WINDOW w AS (ORDER BY word * 1048576 + pos)) p
            JOIN merges m ON m.head = p.tok AND m.tail = p.next_tok AND p.word = p.next_word
            GROUP BY p.word)
    ) b ON b.word = s.word AND s.pos <> b.gone
)
SELECT word, tok FROM state JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) USING (word, step)
ORDER BY word, pos
"""

#: One step for a long word: its pairs of the least rank that do not overlap, from the left, up
#: to the first whose new token forms a pair of a lower rank, which then comes first.
_LONG_STEP = """
CREATE OR REPLACE TEMP TABLE next_state AS
WITH pairs AS (
    SELECT p.*, m.merged, min(m.merged) OVER () AS least
    FROM (SELECT pos, tok, row_number() OVER w AS spot, lag(tok) OVER w AS last_tok, lead(tok) OVER w AS next_tok,
                 lead(tok, 2) OVER w AS after_tok
          FROM state WINDOW w AS (ORDER BY pos)) p
    LEFT JOIN merges m ON m.head = p.tok AND m.tail = p.next_tok
), hits AS (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY spot) AS inside
    FROM (SELECT *, spot - row_number() OVER (ORDER BY spot) AS run FROM pairs WHERE merged = least)
), picked AS (
    SELECT spot, merged, after_tok,
           CASE WHEN lag(spot) OVER (ORDER BY spot) = spot - 2 THEN merged ELSE last_tok END AS before_tok
    FROM hits WHERE inside % 2 = 1
), lower AS (
    SELECT min(spot) AS spot FROM (
        SELECT p.spot FROM picked p JOIN merges m ON m.head = p.before_tok AND m.tail = p.merged
        WHERE m.merged < p.merged
        UNION ALL
        SELECT p.spot FROM picked p JOIN merges m ON m.head = p.merged AND m.tail = p.after_tok
        WHERE m.merged < p.merged)
), chosen AS (
    SELECT spot, merged FROM picked WHERE spot <= coalesce((SELECT spot FROM lower), 9223372036854775807)
)
SELECT p.pos, coalesce(c.merged, p.tok) AS tok
FROM pairs p LEFT JOIN chosen c ON c.spot = p.spot
WHERE p.spot - 1 NOT IN (SELECT spot FROM chosen)
"""

#: The one thread of a task's database adds up a text's pieces in the order they come in.
_DECODE = """
SELECT part, string_agg(text, '') AS text FROM (
    SELECT i.part, v.text FROM ids i JOIN vocabulary v ON v.id = i.id ORDER BY i.pos)
GROUP BY part ORDER BY part
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file; the rank is the id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """head, tail, merged: every split of every token into two tokens."""
    rows = [
        (ranks[token[:at]], ranks[token[at:]], rank)
        for token, rank in ranks.items()
        for at in range(1, len(token))
        if token[:at] in ranks and token[at:] in ranks
    ]
    head, tail, merged = (np.array(column, np.int64) for column in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
    return pa.table({"head": head, "tail": tail, "merged": merged})


class Encoder:
    """Encodes words in DuckDB and keeps what it has encoded; one per task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, merges: pa.Table | None = None):
        self.words = regex.compile(pattern).findall
        self.each_word = regex.compile(pattern).finditer
        self.spelled = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
        self.db.register("given", merge_table(ranks) if merges is None else merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)

    def start(self, words: list[bytes]) -> pa.Table:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        word = np.repeat(np.arange(len(words)), lengths)
        tokens = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        return pa.table({"word": word, "pos": np.arange(len(word)) - first, "tok": tokens})

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, number of ids per word)."""
        self.db.register("start", self.start(words))
        result = self.db.sql(_ENCODE).to_arrow_table()
        self.db.unregister("start")
        return result["tok"].to_numpy().astype(np.int32), np.bincount(result["word"].to_numpy(), minlength=len(words))

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether two tokens next to each other are encoded as these two."""
        both = self.encode_words([self.spelled[left] + self.spelled[right]])[0]
        return both.tolist() == [left, right]

    def encode_long(self, word: bytes) -> np.ndarray:
        """Ids of a word, window by window.

        A row of tokens is the encoding of its bytes if any two neighbours stay apart: the first
        merge across a boundary would also be made between the two alone. Of a window, the first
        half of its tokens is settled, and the next one starts behind them. Where it does not stay
        apart from them, both go back half a window, and the window grows.
        """
        settled: list[np.ndarray] = []
        ends: list[int] = []  # of the settled parts, in bytes
        size = WINDOW
        while True:
            start = ends[-1] if ends else 0
            ids = self.encode_window(word[start : start + size])
            if settled and not self.stay_apart(int(settled[-1][-1]), int(ids[0])):
                settled.pop()
                ends.pop()
                size *= 2
                continue
            if start + size >= len(word):
                return np.concatenate([*settled, ids])
            kept = ids[: max(1, len(ids) // 2)]
            settled.append(kept)
            ends.append(start + sum(len(self.spelled[int(token)]) for token in kept))

    def encode_window(self, word: bytes) -> np.ndarray:
        self.db.register("start", self.start([word]))
        self.db.execute("CREATE OR REPLACE TEMP TABLE state AS SELECT * FROM start")
        self.db.unregister("start")
        left = len(word)
        while True:
            self.db.execute(_LONG_STEP)
            self.db.execute("DROP TABLE state")
            self.db.execute("ALTER TABLE next_state RENAME TO state")
            now = self.db.sql("SELECT count(*) FROM state").fetchall()[0][0]
            if now == left:
                break
            left = now
        return self.db.sql("SELECT tok FROM state ORDER BY pos").to_arrow_table()["tok"].to_numpy().astype(np.int32)

    def learn(self, words: pa.StringArray) -> np.ndarray:
        """Which of the kept words each of some distinct words is; those not seen so far are encoded."""
        if self.known.nbytes + self.ids.nbytes + self.offsets.nbytes + words.nbytes > KEPT_BYTES:
            self.forget()
        found = pc.index_in(words, value_set=self.known)
        which = found.fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(which < 0)
        long = pc.binary_length(words).to_numpy()[new] > LONG_WORD
        new = np.concatenate([new[long], new[~long]])
        which[new] = len(self.known) + np.arange(len(new))
        added = words.take(pa.array(new))
        names = added.cast(pa.binary()).to_pylist()
        pieces, counts = [self.ids], [np.diff(self.offsets)]
        for word in names[: long.sum()]:
            pieces.append(self.encode_long(word))
            counts.append(np.array([len(pieces[-1])]))
        for at in range(long.sum(), len(names), WORDS_PER_QUERY):
            ids, sizes = self.encode_words(names[at : at + WORDS_PER_QUERY])
            pieces.append(ids)
            counts.append(sizes)
        self.known = pa.concat_arrays([self.known, added])
        self.ids = np.concatenate(pieces)
        self.offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return which

    def matches(self, texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """Matches of the pattern, a bounded number at a time, and how many are of each text."""
        found: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for number, text in enumerate(texts):
            if len(text) <= MATCHES_AT_ONCE:
                parts = [self.words(text)]
            else:  # a very long text is not cut into words all at once
                each = (match.group() for match in self.each_word(text))
                parts = iter(lambda: list(itertools.islice(each, MATCHES_AT_ONCE)), [])
            for part in parts:
                if found and len(found) + len(part) > MATCHES_AT_ONCE:
                    yield found, counts
                    found, counts = [], np.zeros(len(texts), np.int64)
                found.extend(part)
                counts[number] += len(part)
        yield found, counts

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids per text)."""
        ids, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        for found, several in self.matches(texts):
            coded = pa.array(found, pa.string()).dictionary_encode()
            codes = self.learn(coded.dictionary)[coded.indices.to_numpy()]
            starts, sizes = self.offsets[codes], self.offsets[codes + 1] - self.offsets[codes]
            total = np.concatenate([[0], np.cumsum(sizes)])
            ids.append(self.ids[np.repeat(starts - total[:-1], sizes) + np.arange(total[-1])])
            counts += np.diff(total[np.concatenate([[0], np.cumsum(several)])])
        return np.concatenate(ids), counts


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ids (array<int>) of every row of ``docs`` (doc_id, text), and the columns in ``keep``.

    Each match of ``pattern`` is encoded by itself; special tokens are ordinary text. A null
    text counts as empty and has no ids. A text and its ids must fit into the memory of a task,
    a text of one long word too. Repeated rows are kept, an empty table gives no row,
    and other columns are not read. The ranks must cover all 256 bytes; their number, that
    of a tokenizer file, bounds what is sent to the tasks.
    """
    spark = prepare(docs.sparkSession)
    shipped = spark.sparkContext.broadcast((ranks, pattern, merge_table(ranks)))

    @lean
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in text_slices(batches, SLICE_BYTES):
            encoder = encoder or Encoder(*shipped.value)
            texts = batch.column("text")
            ids, counts = encoder.encode_texts([text or "" for text in texts.to_pylist()])
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            beside = [name for name in keep if name != "text"]
            columns = [batch.column("doc_id"), lists, *[texts] * ("text" in keep), *map(batch.column, beside)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", *["text"] * ("text" in keep), *beside])

    kinds = dict(docs.dtypes)
    beside = [name for name in keep if name != "text"]
    fields = [("doc_id", kinds["doc_id"]), ("ids", "array<int>"), *[("text", "string")] * ("text" in keep)]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in [*fields, *[(name, kinds[name]) for name in beside]])
    return docs.select("doc_id", "text", *beside).mapInArrow(kernel, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The columns of ``encoded``, and ``decoded`` (binary): the bytes of ``ids``.

    A null list counts as empty; an id without a token is an error.
    """
    spark = prepare(encoded.sparkSession)
    shipped = spark.sparkContext.broadcast(ranks)

    @lean
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = None
        for batch in batches:
            if db is None:
                db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
                ranks = shipped.value
                # one character per byte, so that any bytes can be text
                names = pa.array([token.decode("latin-1") for token in ranks])
                db.register("given", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "text": names}))
                db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
                known = pa.array(list(ranks.values()), pa.int32())
            values = batch.column("ids").flatten()
            if not pc.all(pc.is_in(values, value_set=known)).as_py() and len(values):
                raise ValueError("ids without a token")
            lengths = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            made = pa.array(decode_lists(db, values, lengths), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, "decoded"])

    def decode_lists(db, values: pa.Array, lengths: np.ndarray) -> list[bytes]:
        """Bytes of each list; a list's ids may be spread over several queries."""
        part = np.repeat(np.arange(len(lengths)), lengths)
        pieces: list[list[bytes]] = [[] for _ in lengths]
        for start in range(0, len(part), IDS_PER_QUERY):
            some = slice(start, start + IDS_PER_QUERY)
            ids = values.slice(start, IDS_PER_QUERY)
            db.register("ids", pa.table({"part": part[some], "pos": np.arange(len(ids)), "id": ids}))
            result = db.sql(_DECODE).to_arrow_table()
            db.unregister("ids")
            for place, text in zip(result["part"].to_pylist(), result["text"].to_pylist()):
                pieces[place].append(text.encode("latin-1"))
        return [b"".join(piece) for piece in pieces]

    fields = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(kernel, f"{fields}, decoded binary")


def public_tokenizer(name: str = "byte_bpe_50k.tiktoken") -> tuple[dict[bytes, int], str]:
    """(ranks, pattern) of a file of the installed public tokenizers."""
    import public_tokenizers

    return load_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


@query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, digested, decoded and digested again."""
    ranks, pattern = public_tokenizer()
    encoded = encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, pattern)
    return decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
