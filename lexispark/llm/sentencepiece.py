"""SentencePiece encoding and decoding by streaming Viterbi over a public vocabulary.

Text is taken as SentencePiece takes it: a space in front, spaces kept as part of the pieces, and characters outside the
vocabulary spelled as byte pieces.  Scores: the vocabulary is a BPE one whose stored scores are merge ranks, not log
probabilities, so a piece of rank r costs -log of the Zipf probability 1 / ((r + 1) H); costs are whole thousandths of a
nat, which makes sums exact and runs agree.  Of equally cheap segmentations the one whose last piece is longest wins,
from the end backwards.

The Viterbi pass goes over a text left to right and keeps scores for the positions a piece can still reach (the longest
piece bounds that window).  As soon as the backpointers of all surviving positions lead to one boundary, the ids before it
are committed and forgotten, and so is every backpointer that no surviving path uses.  (Where paths never meet, as in one
letter repeated, the surviving ones are kept.)  No piece holds a space behind another character, so the boundary in front
of a word always is such a point; the ids of a short stretch between two of these are remembered per worker, in a table
of a fixed number of entries, as a cache in front of the pass.  All stretches, of any length, go through the one pass.

Defined results: a null text has null ids, an empty one no ids; repeated rows repeat; very long texts are coded whole;
every string comes back from decoding exactly, the word-boundary mark itself and unknown scripts included; an empty table
gives an empty result.  Extra columns stay as they are, except that those named like a column that is added are replaced.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from lexispark.llm.common import lists, remembered, slices, utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Stretches that a worker remembers; as many older ones are kept beside them.
REMEMBERED = 600_000
_BYTE_COST = 20_000


class Vocabulary:
    """Pieces, costs and a prefix table; small (32,000 pieces), read by the driver and broadcast."""

    def __init__(self, pieces: list[tuple[str, float, bool, bool]]):
        """pieces: text, score, is it a byte, is it a control or unknown piece; in order of ids."""
        total = sum(1 / (r + 1) for r in range(len(pieces)))
        self.bytes = [0] * 256
        self.spelled: list[bytes] = []
        self.prefixes: dict[str, tuple[int, int]] = {}
        self.pieces: dict[str, int] = {}
        for i, (text, score, is_byte, control) in enumerate(pieces):
            if is_byte:
                self.bytes[int(text[3:5], 16)] = i
                self.spelled.append(bytes([int(text[3:5], 16)]))
                continue
            self.spelled.append(b"" if control else text.replace("▁", " ").encode())
            if control:
                continue
            text = text.replace("▁", " ")
            rank = min(-score, len(pieces))
            self.pieces[text] = i
            for k in range(1, len(text)):
                self.prefixes.setdefault(text[:k], (-1, 0))
            self.prefixes[text] = (i, round(1000 * (math.log(rank + 1) + math.log(total))))
        self.longest = max(map(len, self.pieces), default=1)
        if any(" " in p.lstrip(" ") for p in self.pieces) or any("\n" in p for p in self.pieces):
            raise ValueError("a piece crosses a word or line boundary")

    @staticmethod
    @lru_cache
    def load(path: str = MODEL) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        rows = []
        for i in range(sp.get_piece_size()):
            rows.append((sp.id_to_piece(i), sp.get_score(i), sp.is_byte(i), sp.is_control(i) or sp.is_unknown(i)))
        return Vocabulary(rows)


def viterbi(text: str, vocabulary: Vocabulary, commit: Callable[[list[int]], None] | None = None) -> list[int]:
    """Ids of the cheapest segmentation of a text in which spaces are part of the pieces; commit takes them as they are committed.

    Costs are held for the boundaries ahead that a piece reaches.  Of those behind, the ones on a cheapest path to one ahead
    are kept: `heirs` counts the boundaries that follow one directly on such paths, `sums` adds up their places, and a
    boundary without heirs is forgotten.  As soon as the last committed boundary has one heir, all surviving paths go
    through that, and it is committed.
    """
    get, n, ids = vocabulary.prefixes.get, len(text), []
    commit = commit or ids.extend
    cost, before, piece, heirs, sums, base = {0: 0}, {}, {}, {}, {}, 0

    def release(k: int, heir: int) -> None:
        while heirs[k] == 1:
            del heirs[k], sums[k], piece[k]
            heir, k = k, before.pop(k)
        heirs[k] -= 1
        sums[k] -= heir

    def spelled(k: int, j: int) -> list[int]:
        return [piece[j]] if piece[j] >= 0 else [vocabulary.bytes[b] for b in text[k:j].encode("utf-8", "surrogatepass")]

    for i in range(n):
        if i not in cost:
            continue
        here = cost.pop(i)
        count = places = 0
        single = False
        for j in range(i + 1, n + 1):
            found = get(text[i:j])
            if found is None:
                break
            name, price = found
            if name >= 0:
                if j == i + 1:
                    single = True
                price += here
                if j not in cost or price < cost[j]:
                    if j in cost:
                        release(before[j], j)
                    cost[j], before[j], piece[j] = price, i, name
                    count += 1
                    places += j
        if not single:  # spelled by bytes
            j, price = i + 1, here + _BYTE_COST * len(text[i].encode("utf-8", "surrogatepass"))
            if j not in cost or price < cost[j]:
                if j in cost:
                    release(before[j], j)
                cost[j], before[j], piece[j] = price, i, -1
                count += 1
                places += j
        if not count:
            del piece[i]
            release(before.pop(i), i)
            continue
        heirs[i], sums[i] = count, places
        while heirs[base] == 1 and sums[base] <= i:
            j = sums.pop(base)
            commit(spelled(base, j))
            del heirs[base], before[j], piece[j]
            base = j
    steps, j = [], n
    while j > base:
        steps.append(spelled(before[j], j))
        j = before[j]
    for step in reversed(steps):
        commit(step)
    return ids


class _Stretches(dict):
    """Ids of a stretch as bytes of int32."""

    def __init__(self, vocabulary: Vocabulary, front: str):
        super().__init__()
        self.vocabulary, self.front, self.older = vocabulary, front, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = array("i", viterbi(self.front + word, self.vocabulary)).tobytes()
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)  # what is used again comes back from there
                self.clear()
            self[word] = ids
        return ids


_RUNS = re.compile(r" +[^ ]*|[^ ]+")


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.spaced, self.bare = _Stretches(vocabulary, " "), _Stretches(vocabulary, "")
        self.line = np.array([vocabulary.bytes[10]], np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        """int32 ids."""
        if not text:
            return b""
        spaced, bare, parts = self.spaced, self.bare, []
        for k, line in enumerate((" " + text).split("\n")):
            if k:
                parts.append(self.line)
            if "  " in line or line[-1:] == " ":
                parts += [spaced[w[1:]] if w[0] == " " and w[1:2] not in ("", " ") else bare[w] for w in _RUNS.findall(line)]
            elif line:
                first, *rest = line.split(" ")
                if first:
                    parts.append(bare[first])
                parts += [spaced[w] for w in rest]
        return b"".join(parts)


def decode_bytes(ids: list[int], vocabulary: Vocabulary) -> bytes:
    return b"".join(map(vocabulary.spelled.__getitem__, ids))[1:]


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", model: str = MODEL, check_col: str | None = None) -> DataFrame:
    """Replaces the text by its ids; check_col: also says whether decoding gave the text back."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    kept = [f for f in docs.schema.fields if f.name != text_col and f.name != ids_col and f.name != check_col]
    docs = docs.select(*[f"`{f.name}`" for f in kept], f"`{text_col}`")
    schema = StructType(kept + [StructField(ids_col, ArrayType(IntegerType()))] + ([StructField(check_col, BooleanType())] if check_col else []))

    def run(batches):
        encoder = remembered(("encoder", id(shared.value)), lambda: Encoder(shared.value))
        for batch in batches:
            text = batch.column(len(kept))
            _, offsets = utf8(text)
            for i, j in slices(offsets):
                rows = text.slice(i, j - i)
                values = rows.to_pylist()
                coded = [encoder.encode(t) if t else b"" for t in values]
                ids = np.frombuffer(b"".join(coded), np.int32)
                column = lists(ids, np.array([len(c) // 4 for c in coded], np.int64), pa.int32())
                if rows.null_count:
                    column = pa.ListArray.from_arrays(column.offsets, column.values, mask=rows.is_null())
                out = [batch.column(c).slice(i, j - i) for c in range(len(kept))] + [column]
                if check_col:
                    same = []
                    for t, c in zip(values, coded, strict=True):
                        same.append(decode_bytes(np.frombuffer(c, np.int32).tolist(), encoder.vocabulary) == (t or "").encode())
                    out.append(pa.array(same))
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in kept] + [ids_col] + [check_col] * bool(check_col))

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, ids_col: str = "ids", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """Adds the text that the ids spell; null for null ids.  Ids outside the vocabulary raise an error."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    kept = [f for f in rows.schema.fields if f.name != text_col]
    rows = rows.select(*[f"`{f.name}`" for f in kept])
    at = [f.name for f in kept].index(ids_col)
    schema = StructType(kept + [StructField(text_col, StringType())])

    def run(batches):
        vocabulary = shared.value
        for batch in batches:
            texts = [None if x is None else decode_bytes(x, vocabulary).decode("utf-8", "replace") for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(texts, pa.string())], names=batch.schema.names + [text_col])

    return rows.mapInArrow(run, schema)
