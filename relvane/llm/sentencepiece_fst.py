"""SentencePiece encoding and decoding by a weighted finite-state transducer (operator 10).

The transducer of a BPE model is the normaliser (spaces to U+2581, one in front), then the pieces, then byte fallback.
Composed with an input it is a lattice: states are places in the text together with the piece that led there, arcs are pieces.
A BPE result is known by its neighbours: it is the one path whose every two neighbouring pieces are themselves
what BPE makes of their joined characters (Berglund and van der Merwe, 2023). Such a junction has weight 0, any other
weight infinity, and a character without a piece goes through its bytes. The tropical-semiring shortest path is then the
path of weight 0, found by a depth-first search of arcs of weight 0; as prefixes of BPE results are BPE results of prefixes,
each place has one state of finite weight, so the search leaves no place twice.
"""

from __future__ import annotations

import re
import struct
from array import array
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import raw_texts, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NORMAL, BYTE, BPE = 1, 6, 2
MARK = "▁"


def fields(data: bytes):
    """(number, value) of the fields of a protocol buffer message."""
    i = 0

    def number():
        nonlocal i
        out = shift = 0
        while True:
            x = data[i]
            i += 1
            out |= (x & 127) << shift
            shift += 7
            if x < 128:
                return out

    while i < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[i : i + n]
            i += n


def read_model(path: str) -> dict:
    """Pieces, scores and kinds of a model file, and its normaliser's flags. Only BPE with an identity map is compiled here."""
    pieces, trainer, rules = [], {}, {}
    with open(path, "rb") as f:
        for k, v in fields(f.read()):
            if k == 1:
                x = dict(fields(v))
                pieces.append((x[1].decode(), struct.unpack("<f", x.get(2, bytes(4)))[0], x.get(3, NORMAL)))
            elif k == 2:
                trainer = dict(fields(v))
            elif k == 3:
                rules = dict(fields(v))
    if trainer.get(3) != BPE or rules.get(2) or rules.get(4, 1) or not rules.get(3, 1):
        raise ValueError("this transducer takes BPE models with an identity normaliser, a space in front and no spaces removed")
    return {"pieces": pieces}


class Known(dict):
    """Paths of stretches, as bytes of 32-bit ids; a bounded number of short ones is kept."""

    def __init__(self, fst: Transducer):
        self.fst = fst

    def __missing__(self, part: str) -> bytes:
        ids = array("i", self.fst.path(part)).tobytes()
        if len(part) <= 64:
            if len(self) >= self.fst.most:
                self.clear()
            self[part] = ids
        return ids


class Transducer:
    """Encodes and decodes; built once for each Python worker from the model's pieces."""

    def __init__(self, model: dict, most: int = 400_000):
        pieces = model["pieces"]
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.score = [s for _, s, _ in pieces]
        self.text = [p for p, _, _ in pieces]
        self.length = [len(p) for p in self.text]
        self.letters = {p for p in self.ids if len(p) == 1}
        self.trie: dict = {}  # a node: its next characters, and under None the piece that ends there
        for p, i in self.ids.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[None] = i
        self.shorter = [-1] * len(pieces)  # the longest other piece that a piece starts with
        for p, i in self.ids.items():
            self.shorter[i] = next((j for k in range(len(p) - 1, 0, -1) if (j := self.ids.get(p[:k])) is not None), -1)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown = next((i for i, (_, _, kind) in enumerate(pieces) if kind == 2), 0)
        self.spoken = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() if kind == NORMAL else " ⁇ ".encode() if kind == 2 else b"" for p, _, kind in pieces]
        self.fits: dict[int, bool] = {}
        self.reached: dict[int, bool] = {}
        self.most = most
        self.known = Known(self)
        inner = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "".join(re.escape(c) for c in map(chr, range(33)) if c not in inner)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            self.split = re.compile(f"[^{alone}]+|[{alone}]", re.S)
        else:  # no piece goes from a word into the next space: words are paths of their own
            self.split = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+|[{alone}]", re.S)

    def merged(self, parts: list[str]) -> list[str]:
        """BPE by its definition, for the weights of junctions: joins the pair of the best score, the leftmost on ties."""
        while True:
            best = max(((self.score[i], -k) for k in range(len(parts) - 1) if (i := self.ids.get(parts[k] + parts[k + 1])) is not None), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def whole(self, i: int) -> bool:
        """Whether BPE ever makes this piece."""
        if (ok := self.reached.get(i)) is None:
            ok = self.reached[i] = len(self.merged(list(self.text[i]))) == 1
        return ok

    def junction(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a (below 0: no piece): weight 0 or infinity."""
        ok = self.whole(b) and (a < 0 or self.merged(list(self.text[a] + self.text[b])) == [self.text[a], self.text[b]])
        if len(self.fits) > 4 * self.most:
            self.fits.clear()
        self.fits[a * len(self.text) + b] = ok
        return ok

    def longest(self, text: str, at: int) -> int:
        """The longest piece that starts at a place."""
        node, found = self.trie, -1
        for k in range(at, len(text)):
            if (node := node.get(text[k])) is None:
                break
            found = node.get(None, found)
        return found

    def pieces(self, text: str) -> list[int]:
        """The shortest path through characters that all have pieces.

        Every finite path weighs 0, so the search takes arcs of weight 0 until one path ends the text, long pieces first. A
        place has one state of finite weight: one that leads nowhere is dead, and no place is left twice.
        """
        out, dead, fits, many = [], bytearray(len(text) + 1), self.fits, len(self.text)
        at, before, i = 0, -1, self.longest(text, 0)
        while True:
            while i >= 0:
                end = at + self.length[i]
                if not dead[end]:
                    ok = fits.get(before * many + i)
                    if ok is None:
                        ok = self.junction(before, i)
                    if ok:
                        break
                i = self.shorter[i]
            if i >= 0:
                out.append(i)
                if end == len(text):
                    return out
                at, before, i = end, i, self.longest(text, end)
            else:
                dead[at] = 1
                last = out.pop()
                at, before, i = at - self.length[last], out[-1] if out else -1, self.shorter[last]

    def path(self, text: str) -> list[int]:
        """The shortest path through one stretch of normalised text; characters without a piece go through their bytes."""
        if self.letters.issuperset(text):
            return self.pieces(text)
        out: list[int] = []
        for known, run in groupby(text, self.letters.__contains__):
            part = "".join(run)
            out += self.pieces(part) if known else [self.bytes.get(x, self.unknown) for x in part.encode("utf-8", "surrogatepass")]
        return out

    def encode(self, text: str) -> array:
        out = array("i")
        if text:
            out.frombytes(b"".join(map(self.known.__getitem__, self.split.findall(MARK + text.replace(" ", MARK)))))
        return out

    def decode(self, ids) -> str:
        text = b"".join(map(self.spoken.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, decoded): a text's piece ids, and the text that these ids decode to. A null text has null for both.

    An empty text has no ids. Decoding restores any text but one that holds U+2581, which decodes to a space. The model's
    pieces, a table of fixed size, travel to the executors; the file is read by the driver alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))

    def run(batches):
        import pyarrow as pa

        fst = Transducer(shared.value)
        for batch in batches:
            docs_, texts = batch.column("doc_id"), batch.column("text")
            for at in range(0, len(texts), 256):
                flat, offsets, told = array("i"), [], []
                for text in texts[at : at + 256].to_pylist():
                    offsets.append(None if text is None else len(flat))
                    if text is None:
                        told.append(None)
                        continue
                    ids = fst.encode(text)
                    flat.extend(ids)
                    told.append(fst.decode(ids))
                lists = pa.ListArray.from_arrays(pa.array([*offsets, len(flat)], pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else np.array([], np.int32)))
                yield pa.RecordBatch.from_arrays([docs_[at : at + 256], lists, pa.array(told, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decoded(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(read_model(model))

    def run(batches):
        import pyarrow as pa

        fst = Transducer(shared.value)
        for batch in batches:
            out = [None if ids is None else fst.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encoded(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
