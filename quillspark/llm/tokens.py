"""Token counts of a SentencePiece BPE model: pieces counted once per distinct pre-token, joined, summed.

No piece of the model crosses from a word to a following blank, so that its merges never leave a pre-token: a run of
blanks with the word after it. The corpus's distinct pre-tokens make a vocabulary table, in which the library counts the
pieces of each once. A document's count is the sum, over its pre-tokens' frequencies, of the counts that the join finds.
The most frequent pre-tokens, as many as a fixed number of bytes holds, are broadcast, so that only the rare ones are dealt
out. No ids are made.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of_bytes, ship, stored, tune

LIMIT = 4096
BLANK = "▁"
#: Distinct pre-tokens that a task gathers before it passes their frequencies on.
GATHERED = 400_000
#: Bytes of the vocabulary that is broadcast; an entry takes its text and ENTRY bytes.
HOT_BYTES, ENTRY = 32 << 20, 100

_models: dict[bytes, tuple] = {}


def _model(data: bytes) -> tuple:
    """The library's model, and the tokens that a single blank at a text's end adds."""
    key = data[:64] + len(data).to_bytes(8, "little")
    if key not in _models:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i).lstrip(BLANK)
            if BLANK in piece or " " in piece:
                raise ValueError(f"piece {i} crosses a blank: counts by pre-token would differ from the library's")
        _models[key] = model, len(model.encode("a ")) - len(model.encode("a"))
    return _models[key]


def pre_tokens(text: str) -> list[str]:
    """A text's pre-tokens, each without the one blank that the library puts before what it encodes."""
    if not text:
        return []
    if BLANK in text:
        text = text.replace(BLANK, " ")
    words = text.split(" ")
    if "" not in words:
        return words
    out, blanks = [], 0
    for k, w in enumerate(words):
        if w:
            out.append(" " * blanks + w)
            blanks = 0
        elif k < len(words) - 1:
            blanks += 1
        else:
            out.append(" " * blanks)
    return out


def pieces(pre: list[str], data: bytes) -> list[int]:
    """Pieces of each pre-token; "" is a single blank at a text's end."""
    model, lone = _model(data)
    out = []
    for start in range(0, len(pre), 10_000):
        part = pre[start : start + 10_000]
        out += [len(ids) if w else lone for w, ids in zip(part, model.encode(part, num_threads=1), strict=True)]
    return out


def vocabulary(docs: DataFrame, data) -> DataFrame:
    """docs(text): a stored table (pre, freq, n): each distinct pre-token, how often it occurs, its pieces."""
    gathered = pa.schema([("pre", pa.string()), ("freq", pa.int64())])
    counted = pa.schema([("pre", pa.string()), ("freq", pa.int64()), ("n", pa.int64())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            table = pa.table([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], schema=gathered)
            yield from table.to_batches(max_chunksize=20_000)
            seen.clear()

        for batch in batches:
            for text in batch.column(0):
                seen.update(pre_tokens(text.as_py()))
                if len(seen) > GATHERED:
                    yield from rows()
        yield from rows()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(pieces(batch.column(0).to_pylist(), data.value), pa.int64())], schema=counted)

    freq = docs.select("text").mapInArrow(gather, "pre string, freq long").groupBy("pre").agg(F.sum("freq").alias("freq"))
    return stored(freq.mapInArrow(count, "pre string, freq long, n long"), "vocabulary")


def hot_level(vocab: DataFrame, size: int) -> int:
    """The least power of two so that the pre-tokens which occur as often at least take `size` bytes at most."""
    by_level = vocab.groupBy(F.floor(F.log2("freq")).alias("level")).agg(F.sum(F.octet_length("pre") + ENTRY).alias("size")).orderBy(F.desc("level")).collect()  # a row for each power of two
    level, total = 64, 0
    for r in by_level:
        total += r["size"]
        if total > size:
            break
        level = r["level"]
    return level


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """docs(doc_id, text, ...): doc_id, n_bytes, n_tokens, over_limit, one row for each row of docs.

    Null and empty texts have 0 tokens; nothing is cut or padded; special strings inside texts are ordinary text; repeated
    rows and ids are counted each; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(model_path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())  # a vocabulary file: its size is fixed
    text = F.coalesce(F.col("text"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    vocab = vocabulary(source, data)
    level = hot_level(vocab, hot_bytes)
    hot = spark.sparkContext.broadcast({r["pre"]: r["n"] for r in vocab.where(F.col("freq") >= F.lit(2.0**level)).select("pre", "n").collect()})  # hot_bytes at most

    rare = pa.list_(pa.struct([("pre", pa.string()), ("freq", pa.int32())]))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n", pa.int64()), ("rare", rare)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, known = TaskContext.get().partitionId() << 33, hot.value
        for batch in batches:
            for part in batches_of_bytes(batch, 256):
                sums, ends, pre, freq = [], [0], [], []
                for t in part.column(1):
                    total = 0
                    for w, k in Counter(pre_tokens(t.as_py())).items():
                        n = known.get(w)
                        if n is None:
                            pre.append(w)
                            freq.append(k)
                        else:
                            total += n * k
                    sums.append(total)
                    ends.append(len(pre))
                items = pa.StructArray.from_arrays([pa.array(pre, pa.string()), pa.array(freq, pa.int32())], fields=list(rare.value_type))
                rows = pa.array(range(row, row + part.num_rows), pa.int64())
                row += part.num_rows
                yield pa.record_batch([rows, part.column(0), part.column(2), pa.array(sums, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items).cast(rare)], schema=schema)

    parts = stored(source.mapInArrow(work, "row long, doc_id long, n_bytes long, n long, rare array<struct<pre:string,freq:int>>"), "frequencies")
    joined = parts.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(vocab.where(F.col("freq") < F.lit(2.0**level)).select("pre", F.col("n").alias("m")), "pre")
    sums = joined.groupBy("row").agg(F.sum(F.col("freq") * F.col("m")).alias("m"))
    n = F.col("n") + F.coalesce("m", F.lit(0))
    return parts.select("row", "doc_id", "n_bytes", "n").join(sums, "row", "left").select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    """Counts of piece_bpe_32k for all documents."""
    import public_tokenizers

    tune(spark)
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
