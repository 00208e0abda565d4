"""Language-model scores by subword lattice likelihood.

The pieces of an existing vocabulary get unigram scores from the training texts.
A text's probability is the sum over all its segmentations into pieces, each
weighted by the product of its pieces' probabilities: a forward recursion in log
space. No piece reaches over a word's start, so the recursion runs word by word
(a word with its start mark) and the text's log probability is the sum over its
words and the end; every distinct word is scored once in the whole corpus.

Texts are laid out in blocks. Each block lists its distinct words with their
training counts; Spark sums them up per word and sends every block the counts
and scores of its own words, so neither the driver nor a task ever holds the
corpus vocabulary. Only the pieces' scores (bounded by the vocabulary file) are
broadcast.

A character that no piece covers is spelled in byte pieces. Piece counts come
from the vocabulary's own segmentation of the training words; each piece counts
once more than seen.

Defined cases: a null or empty text is just its end; a table without training
rows scores by the smoothed uniform counts; repeated rows score alike and count
as often as they occur; a null doc_id is hashed as the empty text."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.blocks import Rows, each_block, text_blocks
from stationflow.llm.shared import stored

FOLDS, HELD_OUT_FOLD = 7, 2
#: Stands for the end of a text: no word holds white space.
END = b" "
START = "▁"
_LOG10 = math.log(10)


def held_out(doc_id: object) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT_FOLD


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]  # bytes.lower: A-Z only


class Lattice:
    """Forward recursion over a word's characters with piece log scores."""

    def __init__(self, scores: dict[str, float], byte_scores: list[float]) -> None:
        self.scores, self.byte_scores = scores, byte_scores
        self.longest = max(map(len, scores), default=1)
        self.prefixes = {p[:i] for p in scores for i in range(1, len(p) + 1)}

    def spelled(self, char: str) -> float:
        return sum(self.byte_scores[b] for b in char.encode("utf-8", "surrogatepass"))

    def log_probability(self, word: str) -> float:
        """Log of the sum over all segmentations of the marked word."""
        text = START + word
        n = len(text)
        alpha: list[list[float]] = [[] for _ in range(n + 1)]
        alpha[0].append(0.0)
        scores, prefixes = self.scores, self.prefixes
        here = 0.0
        for i in range(n):
            into = alpha[i]
            if len(into) == 1:
                here = into[0]
            else:
                top = max(into)
                here = top + math.log(sum(math.exp(x - top) for x in into))
            alpha[i] = into[:0]
            single = scores.get(text[i])
            alpha[i + 1].append(here + (self.spelled(text[i]) if single is None else single))
            if text[i] in prefixes:
                for j in range(i + 2, min(n, i + self.longest) + 1):
                    piece = text[i:j]
                    if piece not in prefixes:
                        break
                    if piece in scores:
                        alpha[j].append(here + scores[piece])
        top = max(alpha[n])
        return top + math.log(sum(math.exp(x - top) for x in alpha[n]))


def vocabulary_pieces(model: bytes) -> tuple[list[str], list[int]]:
    """Ordinary pieces of a sentencepiece vocabulary that start no word inside,
    and the ids of its byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces, byte_ids = [], [0] * 256
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and START not in piece[1:]:
            pieces.append(piece)
    return pieces, byte_ids


_LOADED: dict = {}


def _processor(model: bytes):
    import sentencepiece

    key = hash(model)
    if key not in _LOADED:
        _LOADED[key] = sentencepiece.SentencePieceProcessor(model_proto=model)
    return _LOADED[key]


def score_documents(documents: DataFrame, vocabulary_path: str, *, block_bytes: int | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for each row (scores in log10)."""
    with open(vocabulary_path, "rb") as f:
        model = f.read()
    context = documents.sparkSession.sparkContext
    shared = context.broadcast(model)
    blocks = text_blocks(documents, **({"block_bytes": block_bytes} if block_bytes else {}))

    def count(block: int, docs: Rows, _: pa.Table | None) -> pa.Table:
        ids, texts = docs.ids, docs.texts
        train, rest = Counter(), set()
        for i, text in zip(ids, texts, strict=True):
            if held_out(i):
                rest.update(tokens(text))
            else:
                train.update(tokens(text))
        words = [*train, *(rest - train.keys())]
        return pa.table({"block": pa.array([block] * len(words), pa.int32()), "word": pa.array(words, pa.binary()), "c": pa.array([train.get(w, 0) for w in words], pa.int64())})

    listed = stored(each_block(blocks, count, "block int, word binary, c long"), "block-words")
    vocabulary = stored(listed.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")
    totals = vocabulary.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    n, v = int(totals["n"] or 0), int(totals["v"] or 0)

    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, counts = _processor(shared.value), Counter()
        for batch in batches:
            words, c = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for pieces, times in zip(sp.encode([w.decode("utf-8", "replace") for w in words], num_threads=1), c, strict=True):
                for p in pieces:
                    counts[p] += times
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int32()), pa.array(counts.values(), pa.int64())], ["piece", "c"])

    trained = vocabulary.where(F.col("c") > 0)
    ends = trained.where(F.col("word") == F.lit(END)).agg(F.sum("c")).first()[0] or 0
    inner = trained.where(F.col("word") != F.lit(END))
    # One row per piece of the vocabulary file, whatever the corpus.
    used = {r["piece"]: r["c"] for r in inner.mapInArrow(segmented, "piece int, c long").groupBy("piece").agg(F.sum("c").alias("c")).collect()}
    pieces, byte_ids = vocabulary_pieces(model)
    sp = _processor(model)
    counted = {p: used.get(sp.piece_to_id(p), 0) + 1 for p in pieces}
    in_bytes = [used.get(i, 0) + 1 for i in byte_ids]
    total = sum(counted.values()) + sum(in_bytes) + ends + 1
    scores = {p: math.log(c / total) for p, c in counted.items()}
    byte_scores = [math.log(c / total) for c in in_bytes]
    end_score = math.log((ends + 1) / total) / _LOG10
    lattice = context.broadcast((scores, byte_scores))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lattice(*lattice.value)
        for batch in batches:
            p = [end_score if w == END else own.log_probability(w.decode("utf-8", "replace")) / _LOG10 for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], ["word", "c", "p"])

    known = vocabulary.mapInArrow(scored, "word binary, c long, p double")
    answers = listed.select("block", "word").join(known, "word").select("block", "word", "c", "p")
    floor = n + v + 1

    def judged(block: int, docs: Rows, words: pa.Table) -> pa.Table:
        ids, texts = docs.ids, docs.texts
        number = {w: i for i, w in enumerate(words["word"].to_pylist())}
        c, p = words["c"].to_numpy(), words["p"].to_numpy()
        base, known = np.log10((c + 1) / floor), c > 0
        n_tokens, n_known, base_score, score = [], [], [], []
        for text in texts:
            found = tokens(text)
            own = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
            n_tokens.append(len(own))
            n_known.append(int(np.count_nonzero(known[own])))
            base_score.append(math.fsum(base[own].tolist()))
            score.append(math.fsum(p[own].tolist()))
        return pa.table({
            "doc_id": pa.array(ids, id_arrow),
            "held_out": pa.array([held_out(i) for i in ids], pa.bool_()),
            "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([n] * len(ids), pa.int64()),
            "base_score": pa.array(base_score, pa.float64()),
            "score": pa.array(score, pa.float64()),
        })

    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(documents.schema["doc_id"].dataType)
    schema = f"doc_id {blocks.id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return each_block(blocks, judged, schema, answers)
