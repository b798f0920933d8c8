"""SentencePiece encoding and decoding with a weighted finite-state transducer.

Three transducers are compiled from a model file: the normaliser (white space escaped as ``▁``, optionally a dummy
prefix), the pieces (a trie, each piece an arc over its characters) and the byte fallback (a character outside the
vocabulary becomes its bytes).  An input is composed with them and the shortest path in the tropical semiring is its
encoding.

For a unigram model an arc weighs minus its piece's score.  A BPE model is no sum of piece scores, so its weights sit
on pairs: going from piece ``a`` to piece ``b`` weighs 0 if the model's merges leave ``a`` and ``b`` as they are on the
text ``ab``, and infinity otherwise.  A sequence of pieces is the BPE encoding of its text exactly if all its
neighbouring pairs are left alone: were some merge the first to cross a border, it would already do so on that pair.
So one finite path remains, with at most one piece ending at each position.  It is found depth first, the longest arc
first, and a position from which the end was not reached is never entered again.

No piece crosses from other characters into ``▁``, so inputs fall into independent chunks there, and the path of a
frequent chunk is remembered (a bounded number of them per task).

Defined cases: null and empty texts have no pieces; a text's own ``▁`` decodes to a space; repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ESCAPE = "▁"
# Piece types of a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
NONE = -2  # no arc
REMEMBERED = 1 << 19  # chunks, or pairs of pieces, per Python worker
ROWS = 256  # rows of an output batch


def read_model(path: str) -> dict:
    """What the transducers are compiled from; plain values, so that they can be sent to tasks."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if rules.precompiled_charsmap:
        raise ValueError("a model with a character map is not supported")
    values = {
        "pieces": [(p.piece, p.score, p.type) for p in model.pieces],
        "bpe": model.trainer_spec.model_type == BPE,
        "fallback": model.trainer_spec.byte_fallback,
        "prefix": rules.add_dummy_prefix,
        "squeeze": rules.remove_extra_whitespaces,
    }
    # Found here once, rather than in every task.
    return values | {"arcs": list(Transducer(values).arcs)}


class _Paths(dict):
    """Paths of chunks, found when first asked for.  Two generations are kept: what was looked up lately survives when the
    older one is dropped."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        path = self.older.get(chunk)
        if path is None:
            path = self.find(chunk)
        # A chunk longer than this is rare and not worth remembering.
        if len(chunk) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[chunk] = path
        return path


class Transducer:
    """Normaliser, pieces and byte fallback of one model, compiled."""

    def __init__(self, model: dict):
        self.prefix, self.squeeze, self.bpe, self.fallback = model["prefix"], model["squeeze"], model["bpe"], model["fallback"]
        self.pieces = [p for p, _, _ in model["pieces"]]
        kinds = [t for _, _, t in model["pieces"]]
        self.unknown = kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(model["pieces"]) if t == BYTE}
        # What a piece decodes to.
        self.output = [
            b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE else p.encode() for p, t in zip(self.pieces, kinds, strict=True)
        ]
        usable = {p: i for i, (p, _, t) in enumerate(model["pieces"]) if t in (NORMAL, USER)}
        self.score = {p: model["pieces"][i][1] for p, i in usable.items()}
        self.ids = usable
        # A piece that the merges can't build is no arc of a BPE transducer.
        if "arcs" in model:
            self.arcs = {p: usable[p] for p in model["arcs"]}
        else:
            self.arcs = {p: i for p, i in usable.items() if len(p) == 1 or not self.bpe or self._merged(p) == [p]}
        # The trie: per first three characters, the lengths that occur, longest first; and of each arc its length and the
        # next shorter one that it begins with.  The last place, -1, is a character outside the vocabulary.
        lengths: dict[str, set[int]] = {}
        for p in self.arcs:
            if len(p) > 2:
                lengths.setdefault(p[:3], set()).add(len(p))
        self.lengths = {k: sorted(v, reverse=True) for k, v in lengths.items()}
        self.size, self.shorter = [1] * (len(self.pieces) + 1), [NONE] * (len(self.pieces) + 1)
        for p, i in self.arcs.items():
            self.size[i] = len(p)
            self.shorter[i] = next((self.arcs[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.arcs), NONE)
        if any(ESCAPE in p.lstrip(ESCAPE) for p in self.arcs):
            raise ValueError("pieces cross into white space")
        self.chunks = re.compile(f"{ESCAPE}*[^{ESCAPE}]+|{ESCAPE}+")
        self.pairs: dict[int, bool] = {}
        self.memory = _Paths(lambda chunk: array("i", self._path(chunk)).tobytes())

    def _merged(self, text: str) -> list[str]:
        """The model's merges on a short text: again and again the best-scored pair, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the pair of pieces weighs 0."""
        key = left << 20 | right
        answer = self.pairs.get(key)
        if answer is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            a, b = self.pieces[left], self.pieces[right]
            answer = self.pairs[key] = self._merged(a + b) == [a, b]
        return answer

    def normalise(self, text: str) -> str:
        """The normaliser's output, with spaces still as spaces."""
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return " " + text if self.prefix and text else text

    def _longest(self, chunk: str, at: int) -> int:
        """The longest arc from a position; -1, a character, if there is none."""
        arcs = self.arcs
        for length in self.lengths.get(chunk[at : at + 3], ()):
            i = arcs.get(chunk[at : at + length])
            if i is not None:
                return i
        i = arcs.get(chunk[at : at + 2])
        return arcs.get(chunk[at], -1) if i is None else i

    def _merge_path(self, chunk: str) -> list[int]:
        """The path of weight 0 over a chunk, for a BPE model."""
        n, size, shorter, pairs, longest = len(chunk), self.size, self.shorter, self.pairs, self._longest
        taken: list[int] = []
        dead: set[int] = set()
        at, last, i = 0, -1, longest(chunk, 0)
        while True:
            if i == NONE:
                dead.add(at)
                back = taken.pop()
                at -= size[back]
                last = taken[-1] if taken else -1
                i = shorter[back]
                continue
            end = at + size[i]
            fits: bool | None = end not in dead
            # Across a character outside the vocabulary every pair weighs 0.
            if fits and last >= 0 and i >= 0:
                fits = pairs.get(last << 20 | i)
                if fits is None:
                    fits = self._compatible(last, i)
            if fits:
                taken.append(i)
                at, last = end, i
                if at == n:
                    return taken
                i = longest(chunk, at)
            else:
                i = shorter[i]

    def _score_path(self, chunk: str) -> list[int]:
        """The path of least weight over a chunk, for a unigram model."""
        n, size = len(chunk), self.size
        cost: list[float] = [0.0] + [float("inf")] * n
        last: list[int] = [NONE] * (n + 1)
        for start in range(n):
            i = self._longest(chunk, start)
            while i != NONE:
                end, weight = start + size[i], -self.score[self.pieces[i]] if i >= 0 else 1e6
                if cost[start] + weight < cost[end]:
                    cost[end], last[end] = cost[start] + weight, i
                following = self.shorter[i]
                # Single characters are always arcs, known or not.
                i = following if following != NONE or size[i] == 1 else -1
        taken = []
        while n:
            taken.append(last[n])
            n -= size[last[n]]
        return taken[::-1]

    def _path(self, chunk: str) -> list[int]:
        path = self._merge_path(chunk) if self.bpe else self._score_path(chunk)
        if -1 not in path:
            return path
        out: list[int] = []
        at = 0
        for i in path:
            if i >= 0:
                out.append(i)
            elif self.fallback:
                out += [self.bytes[b] for b in chunk[at].encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
            at += self.size[i]
        return out

    def packed(self, normal: str) -> bytes:
        """The pieces of a normalised text, four bytes each."""
        return b"".join(map(self.memory.__getitem__, self.chunks.findall(normal.replace(" ", ESCAPE))))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(self.normalise(text)), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The normalised text of pieces; control pieces are silent."""
        out = b"".join(map(self.output.__getitem__, ids))
        text = out.decode("utf-8", "replace").replace(ESCAPE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


_compiled: dict[str, Transducer] = {}


def _transducer(name: str, sent) -> Transducer:
    """The transducer of a broadcast model: a Python worker compiles it once and keeps what it remembers."""
    if name not in _compiled:
        _compiled.clear()
        _compiled[name] = Transducer(sent.value)
    return _compiled[name]


def _model_for(spark, path: str):
    """The model's values, sent to tasks once."""
    return spark.sparkContext.broadcast(read_model(path))


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, ids, decoded, exact): pieces of each text, and whether decoding them gives the normalised text back."""
    model, name = _model_for(docs.sparkSession, path), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(name, model)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                given = batch.column(1).to_pylist()
                normal = [machine.normalise(t) for t in given]
                packed = [machine.packed(t) for t in normal]
                flat = np.frombuffer(b"".join(packed), np.int32)
                ends = np.cumsum([0, *(len(x) // 4 for x in packed)], dtype=np.int32)
                decoded = [machine.decode(np.frombuffer(x, np.int32).tolist()) for x in packed]
                expected = [t.replace(ESCAPE, " ") for t in normal]
                if machine.prefix:
                    expected = [e[1:] if e.startswith(" ") else e for e in expected]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        pa.array(decoded, pa.string()),
                        pa.array([a == b for a, b in zip(decoded, expected, strict=True)]),
                    ],
                    names=["doc_id", "ids", "decoded", "exact"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string, exact boolean")


def decode(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    model, name = _model_for(rows.sparkSession, path), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = _transducer(name, model)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [machine.decode([] if x is None else list(x)) for x in batch["ids"]]})

    return rows.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def op5(docs: DataFrame) -> DataFrame:
    """Counts and digests of pieces and of what they decode to."""
    return encode(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.concat_ws(",", "ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "exact",
    )
