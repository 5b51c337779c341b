"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

All distinct words of a batch lie in one flat symbol array.  A round finds the
best pair rank of every word (segmented minimum), merges it at its leftmost
place in all words at once and compacts the array, until no pair remains.
Where merging a piece can never open a better pair, every place of that piece
in the word is merged in the same round (pairs that overlap: leftmost first).
Words are cut where no piece of the vocabulary can span, so they are
independent and each distinct one is encoded once.

Defined cases: null and empty texts have no ids and decode to the empty text;
characters outside the vocabulary become byte pieces; repeated rows and null
ids are rows like any other; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from strata.llm.common import DataFrame, SparkSession, map_arrow, table

SPACE = "▁"
KEEP_WORDS = 200_000       # distinct words a worker remembers before it starts anew
BATCH_WORDS = 50_000       # new words encoded in one flat array
_NONE = np.int64(1) << 40


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceCodec:
    """Encoder and decoder for a SentencePiece BPE model with byte fallback."""

    def __init__(self, model: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.byte_id = np.full(256, sp.unk_id(), np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(names[i][3:-1], 16)] = i
        symbol = {names[i]: i for i in normal}
        for ch in sorted({c for i in normal for c in names[i]}):
            symbol.setdefault(ch, len(names) + len(symbol))      # never a result, may start a merge
        self.size = max(symbol.values()) + 1
        scores = sorted({-sp.get_score(i) for i in normal})
        place = {s: k for k, s in enumerate(scores)}
        self.rank = np.full(self.size + 1, _NONE, np.int64)
        for i in normal:
            self.rank[i] = place[-sp.get_score(i)]
        keys, merged, near, self.many = [], [], set(), np.ones(self.size + 1, bool)
        for i in normal:
            name = names[i]
            for k in range(1, len(name)):
                near.add(ord(name[k - 1]) << 21 | ord(name[k]))
                left, right = symbol.get(name[:k]), symbol.get(name[k:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    merged.append(i)
                    for part in (left, right):
                        if self.rank[i] <= self.rank[part]:
                            self.many[part] = False
        self._build_pairs(np.array(keys, np.int64), np.array(merged, np.int64))
        self.near = np.array(sorted(near), np.int64)
        chars = {ord(c): i for c, i in symbol.items() if len(c) == 1}
        self.char_symbol = np.full(0x110000, -1, np.int32)
        self.char_symbol[list(chars)] = list(chars.values())
        self.longest_space = max((len(names[i]) for i in normal if set(names[i]) == {SPACE}), default=1)
        if any(SPACE in names[i].lstrip(SPACE) for i in normal):
            raise ValueError("pieces with a space after another character are not supported")
        parts = [b"" if sp.is_control(i) else bytes([int(names[i][3:-1], 16)]) if sp.is_byte(i)
                 else " ⁇ ".encode() if sp.is_unknown(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.part_off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.part_data = np.frombuffer(b"".join(parts), np.uint8)
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.spaced = np.array([names[i].startswith(SPACE) for i in range(n)])
        self.silent = np.array([sp.is_control(i) for i in range(n)])
        self.id_text = np.array([str(i) for i in range(n)], object)
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.word_ids = np.zeros(1 << 16, np.int32)
        self.word_off = np.zeros(1 << 14, np.int64)

    # -- encoding -------------------------------------------------------------
    def _words(self, text: str) -> list[str]:
        text = SPACE + text.replace(" ", SPACE)
        words = self.cut.findall(text)
        block = SPACE * self.longest_space
        if block * 2 in text:
            out = []
            for w in words:                       # a long run of spaces: its leading whole blocks stand alone
                run = len(w) - len(w.lstrip(SPACE))
                lead = max(0, run // self.longest_space - 1)
                out += [block] * lead + [w[lead * self.longest_space:]]
            words = out
        return words

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _build_pairs(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Open-addressed table (left, right) -> merged piece, at most 1/8 full."""
        self.bits = max(10, int(len(keys) * 8).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, -1, np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]           # the last of equal slots stays
            won = self.keys[at] == keys[left]
            self.merged[at[won]] = merged[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that two symbols merge to, or -1."""
        key = left * self.size + right
        key[(left < 0) | (right < 0)] = -2
        slot = self._slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.merged[slot], -1)
        left = np.flatnonzero((there != key) & (there != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[left]]
            out[left] = np.where(there == key[left], self.merged[slot[left]], -1)
            left = left[(there != key[left]) & (there != -1)]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of words that no piece can span."""
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        n = len(flat)
        first = np.zeros(n, bool)
        starts = np.cumsum([0] + [len(w) for w in words])
        first[starts[:-1]] = True
        key = flat[:-1] << 21 | flat[1:]
        at = np.minimum(np.searchsorted(self.near, key), len(self.near) - 1)
        first[1:] |= self.near[at] != key
        seg = np.cumsum(first) - 1
        sym, pos = self.char_symbol[flat].astype(np.int64), np.arange(n)
        result = np.full(n, -2, np.int64)          # at the place of each symbol's first character
        pair = np.full(n, -1, np.int64)
        inner = np.flatnonzero(seg[:-1] == seg[1:])
        pair[inner] = self._pair(sym[inner], sym[inner + 1])
        while len(sym):
            rank = self.rank[pair]                  # rank[-1] is the sentinel
            begin = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            size = np.diff(np.concatenate([begin, [len(seg)]]))
            best = np.repeat(np.minimum.reduceat(rank, begin), size)
            live = best < _NONE
            if not live.all():
                result[pos[~live]] = sym[~live]
                sym, seg, pos, pair, rank, best = (x[live] for x in (sym, seg, pos, pair, rank, best))
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == best)
            lead = np.concatenate([[True], seg[hit[1:]] != seg[hit[:-1]]])      # leftmost of its word
            fresh = lead | np.concatenate([[True], hit[1:] != hit[:-1] + 1])
            run = hit - hit[np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))]
            take = hit[np.where(self.many[pair[hit]], run % 2 == 0, lead)]
            sym[take] = pair[take]
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            moved = np.cumsum(keep) - 1
            sym, seg, pos, pair = sym[keep], seg[keep], pos[keep], pair[keep]
            at = moved[take]
            touched = np.zeros(len(sym) + 1, bool)
            touched[at] = touched[at - 1] = True           # -1 is the spare last place
            if touched[len(sym) - 1]:
                pair[-1] = -1
            at = np.flatnonzero(touched[:len(sym) - 1])
            pair[at] = np.where(seg[at] == seg[at + 1], self._pair(sym[at], sym[at + 1]), -1)
        # characters outside the vocabulary: their UTF-8 bytes
        place = np.flatnonzero(result > -2)
        odd = (result[place] == -1) | (result[place] >= len(self.id_text))
        count = np.ones(len(place), np.int64)
        raw = [chr(c).encode() for c in flat[place[odd]]]
        count[odd] = [len(b) for b in raw]
        off = np.concatenate([[0], np.cumsum(count)])
        ids = np.empty(off[-1], np.int32)
        ids[off[:-1][~odd]] = result[place[~odd]]
        if raw:
            spread = np.repeat(odd, count)
            ids[spread] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        return ids, off[np.searchsorted(place, starts)]

    def _learn(self, words) -> None:
        new = [w for w in words if w not in self.known]
        for a in range(0, len(new), BATCH_WORDS):
            part = new[a:a + BATCH_WORDS]
            ids, off = self.encode_words(part)
            n, used = len(self.known), int(self.word_off[len(self.known)])
            while len(self.word_off) < n + len(part) + 1:
                self.word_off = np.concatenate([self.word_off, np.zeros_like(self.word_off)])
            while len(self.word_ids) < used + len(ids):
                self.word_ids = np.concatenate([self.word_ids, np.zeros_like(self.word_ids)])
            self.word_ids[used:used + len(ids)] = ids
            self.word_off[n + 1:n + len(part) + 1] = used + off[1:]
            self.known.update(zip(part, range(n, n + len(part))))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all texts, one after the other."""
        words = [self._words(t) if t else [] for t in texts]
        if len(self.known) > KEEP_WORDS:
            self._forget()
        self._learn(dict.fromkeys(chain.from_iterable(words)))
        known = self.known
        at = np.array(list(map(known.__getitem__, chain.from_iterable(words))), np.int64)
        size = self.word_off[at + 1] - self.word_off[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.word_ids[np.arange(ends[-1]) + np.repeat(self.word_off[at] - ends[:-1], size)]
        return ids, ends[np.concatenate([[0], np.cumsum([len(ws) for ws in words])]).astype(np.int64)]

    # -- decoding -------------------------------------------------------------
    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        size = self.part_off[ids + 1] - self.part_off[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.part_data[np.arange(ends[-1]) + np.repeat(self.part_off[ids] - ends[:-1], size)].tobytes()
        out, split = [], np.concatenate([[0], np.cumsum(self.silent[ids])])
        for k in range(len(off) - 1):
            raw = data[ends[off[k]]:ends[off[k + 1]]]
            try:        # bytes on both sides of a control piece don't join
                text = raw.decode() if split[off[k]] == split[off[k + 1]] else self._decode_broken(ids[off[k]:off[k + 1]])
            except UnicodeDecodeError:
                text = self._decode_broken(ids[off[k]:off[k + 1]])
            seen = off[k]
            while seen < off[k + 1] and self.silent[ids[seen]]:
                seen += 1
            out.append(text[1:] if seen < off[k + 1] and self.spaced[ids[seen]] else text)   # the added first space
        return out

    def _decode_broken(self, ids: np.ndarray) -> str:
        """Bytes that form no character become U+FFFD, one each."""
        out, run = [], b""
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.part_data[self.part_off[i]:self.part_off[i + 1]].tobytes()
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        run = run[n:]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    run = run[1:]
            if i >= 0:
                out.append(self.part_data[self.part_off[i]:self.part_off[i + 1]].tobytes().decode())
        return "".join(out)


_CODECS: dict[str, PieceCodec] = {}


def codec(model: bytes) -> PieceCodec:
    """The worker's codec for a model (built once per worker)."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = PieceCodec(model)
    return _CODECS[key]


def _pieces(batch: pa.RecordBatch, rows: int = 512):
    """Cuts a batch so that the work arrays stay small next to the texts."""
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """``docs`` with an array column of piece ids.  The model is read once, on
    the driver; the tasks get its bytes."""
    model = read_model(model_path)

    def run(batches):
        c = codec(model)
        for whole in batches:
            for b in _pieces(whole):
                flat, off = c.encode(b.column(text).to_pylist())
                col = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*b.columns, col], [*b.schema.names, ids])

    docs = docs.drop(ids)
    return docs.mapInArrow(run, docs.withColumn(ids, F.lit(None).cast("array<int>")).schema)


def decode_documents(docs: DataFrame, model_path: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text that its piece ids stand for."""
    model = read_model(model_path)

    def run(batches):
        c = codec(model)
        for whole in batches:
            for b in _pieces(whole):
                lists = b.column(ids)
                off = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy())]).astype(np.int64)
                flat = lists.flatten().to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c.decode(flat, off), pa.string())], [*b.schema.names, text])

    docs = docs.drop(text)
    return docs.mapInArrow(run, docs.withColumn(text, F.lit(None).cast("string")).schema)


def round_trip(docs: DataFrame, model_path: str, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """``docs`` with an array column of piece ids, and its text replaced by the
    one decoded from them: one pass, one codec per task."""
    model = read_model(model_path)

    def run(batches):
        c = codec(model)
        for whole in batches:
            for b in _pieces(whole):
                flat, off = c.encode(b.column(text).to_pylist())
                cols = dict(zip(b.schema.names, b.columns))
                cols[text] = pa.array(c.decode(flat, off), pa.string())
                cols[ids] = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    docs = docs.drop(ids)
    return map_arrow(docs, run, docs.withColumn(ids, F.lit(None).cast("array<int>")).schema)


def digests(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    model = read_model(model_path)

    def run(batches):
        c = codec(model)
        for whole in batches:
            for b in _pieces(whole):
                ids, off = c.encode(b.column(text).to_pylist())
                back = c.decode(ids, off)
                names = c.id_text[ids].tolist()
                sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), pa.array(np.diff(off), pa.int64()),
                    pa.array([sha(",".join(names[off[k]:off[k + 1]])) for k in range(len(off) - 1)], pa.string()),
                    pa.array([sha(t) for t in back], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), tokenizer_path())
