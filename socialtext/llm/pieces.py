"""SentencePiece encoding and decoding with a shared-prefix Viterbi search.

Texts are cut into marked words (a run of blanks and what follows it); the model has no piece that crosses such a border.
The distinct marked words of a group of batches are sorted, which is a depth-first walk through their trie: the forward
states of the prefix shared with the word before are reused, and only the rest is searched. For a byte-pair model the
forward state of a prefix is the last piece of its only valid segmentation: a piece may follow another if encoding the two
together gives just these two. The ids are those of the sentencepiece library, byte fallback included.

The vocabulary is read once on the driver from a path that is a parameter and broadcast (its size is that of the model).
Null and empty texts have no ids. A literal U+2581 counts as a blank, as in the library. Repeated rows get equal results;
only the named columns are read; an empty table gives an empty result; a very long text is one group of its own.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from socialtext.llm.tables import prepare

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of text whose marked words share one trie.
GROUP_CHARS = 4 << 20
_MARKED = re.compile("\n| *[^ \n]+| +")


class Vocabulary:
    """Pieces with blanks for marks, their scores and bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.scores, self.bytes_of, self.byte_id = {}, {}, [], [0] * 256
        for i in range(len(model)):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                text = piece.replace("▁", " ")
                self.ids[text], self.scores[text] = i, model.get_score(i)
                self.bytes_of.append(text.encode())
        self.longest = max(map(len, self.ids))

    def merged(self, text: str) -> list[str]:
        """Segmentation of a short text by merging the best-scored neighbours, the leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v, self.follows, self.alone = vocabulary, {}, {}

    def _may_follow(self, before: str, piece: str) -> bool:
        key = (before, piece)
        found = self.follows.get(key)
        if found is None:
            if len(self.follows) > 2_000_000:  # a memory bound of the cache only
                self.follows.clear()
            found = self.follows[key] = self.v.merged(before + piece) == [before, piece]
        return found

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``ids, offsets`` of the words, which must be sorted."""
        ids_of, longest, scores = self.v.ids, self.v.longest, self.v.scores
        last: list[str] = [""]          # last[i]: last piece of the segmentation of the first i characters
        before, flat, offsets = "", [], [0]
        for word in words:
            shared, limit = 0, min(len(word), len(before))
            while shared < limit and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    piece = word[start:end]
                    if piece in scores or end - start == 1:
                        if start:
                            ok = self._may_follow(last[start], piece)
                        else:
                            ok = self.alone.get(piece)
                            if ok is None:
                                ok = self.alone[piece] = self.v.merged(piece) == [piece]
                        if ok:
                            last.append(piece)
                            break
                else:
                    raise ValueError(f"no segmentation of {word[:end]!r}")
            found, at = [], len(word)
            while at:
                piece = last[at]
                found.append(piece)
                at -= len(piece)
            for piece in reversed(found):
                number = ids_of.get(piece)
                if number is None:
                    flat.extend(self.v.byte_id[b] for b in piece.encode())
                else:
                    flat.append(number)
            offsets.append(len(flat))
            before = word
        return np.array(flat, np.int32), np.array(offsets, np.int64)

    def texts(self, texts: list[str | None]) -> pa.ListArray:
        number: dict[str, int] = defaultdict(count().__next__)
        codes = [np.fromiter((number[w] for w in _MARKED.findall(" " + t.replace("▁", " "))), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        words = list(number)
        order = sorted(range(len(words)), key=words.__getitem__)
        flat, offsets = self.words([words[i] for i in order])
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        size = np.diff(offsets)
        ends, ids = [0], []
        for code in codes:  # text by text, so that the numbers in between stay as small as a text
            used = place[code]
            lengths = size[used]
            upto = np.cumsum(lengths)
            ids.append(flat[np.repeat(offsets[:-1][used] - upto + lengths, lengths) + np.arange(upto[-1] if len(upto) else 0)])
            ends.append(ends[-1] + len(ids[-1]))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))


def _schema(df: DataFrame, extra: str) -> str:
    return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields], extra])


def encode(df: DataFrame, text: str = "text", model: str = MODEL, group_chars: int = GROUP_CHARS) -> DataFrame:
    """``df`` with ``ids`` (array of int), the SentencePiece ids of ``text``."""
    prepare(df.sparkSession)
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(model))

    def apply(batches):
        encoder, held, size = Encoder(vocabulary.value), [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            batch = table.to_batches()[0]
            ids = encoder.texts(batch.column(batch.schema.get_field_index(text)).to_pylist())
            return pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.column(batch.schema.get_field_index(text)).nbytes
            if size >= group_chars:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return df.mapInArrow(apply, _schema(df, "ids array<int>"))


def decode(df: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``df`` with ``decoded``: pieces joined, bytes read as UTF-8, without the blank put before the first word. Null stays null."""
    prepare(df.sparkSession)
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(model))

    def apply(batches):
        table = np.array(vocabulary.value.bytes_of, object)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            out = []
            for row in range(len(lists)):
                values = lists[row].values
                if values is None:
                    out.append(None)
                    continue
                joined = b"".join(table[values.to_numpy(zero_copy_only=False)].tolist())
                out.append(joined.removeprefix(b" ").decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decoded"])

    return df.mapInArrow(apply, _schema(df, "decoded string"))


def digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, n_tokens, ids_hash, round_trip`` of every row: encoded, decoded again, compared with the text."""
    both = decode(encode(docs.select("doc_id", "text"), model=model), model=model)
    plain = F.translate(F.coalesce("text", F.lit("")), "▁", " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), (F.col("decoded") == plain).alias("round_trip"))
