"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with
log scores, byte fallback, whitespace markers.

The installed model gives the pieces in the order of their merges but no probabilities, so a piece of
rank r gets the log of its share under Zipf's law, 1 / (r + ``ZIPF``), normalised over all pieces.

A text gets one marker in front; blanks become markers. No piece of the vocabulary has a marker
after another character (checked when the model is read), so the best segmentation of a text is
that of its chunks ``marker* other*``, each found once per task and remembered. Chunks that are
new in a batch go through the Viterbi recursion together, as arrays; long ones are first cut between
characters that stand together in no piece, and go one by one where they stay long. Characters that no piece
covers, and marker characters that the text itself has, are spelled in byte pieces, so decoding
gives back exactly the text.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, id_text, text_bytes

MARK = "▁"
CHUNK = re.compile(r" *[^ ]+| +")
#: Bytes of remembered chunks in a worker, with what Python adds to each.
CACHE, OVERHEAD = 96 << 20, 160
ZIPF = 2.7
#: Chunks of more bytes are encoded one by one, so that padding stays small, and aren't remembered.
LONG = 256
#: Byte in chunks that stands for a marker character of the text (it is in no UTF-8 string).
OWN = b"\xff"


class Trie:
    """Double array over bytes: the child of state s by byte c is ``base[s] + c`` if ``check``
    there is s; ``leaf`` is the piece that ends at a state, or -1."""

    def __init__(self, pieces: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for p, i in pieces.items():
            s = 0
            for c in p:
                if c not in children[s]:
                    children[s][c] = len(children)
                    children.append({})
                    ends.append(-1)
                s = children[s][c]
            ends[s] = i
        size = (len(children) * 3) + 1024
        base, check, leaf = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = bytearray(size)
        used[0] = 1
        place, low, scan = [0] * len(children), 257, 257
        for node in range(len(children)):  # parents come before their children
            kids = sorted(children[node].items())
            if not kids:
                continue
            while used[low]:
                low += 1
            codes = [c for c, _ in kids]
            if len(codes) == 1:  # fills a gap
                b = low - codes[0]
            else:
                b = first = max(low - codes[0], scan)
                while any(used[b + c] for c in codes):
                    b += 1
                scan = b if b - first > 64 else scan
            base[place[node]] = b
            for c, k in kids:
                place[k] = b + c
                used[b + c], check[b + c], leaf[b + c] = 1, place[node], ends[k]
        top = used.rindex(1) + 257
        self.base, self.check, self.leaf = base[:top], check[:top], leaf[:top]
        self.deepest = max(map(len, pieces), default=0)


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte = np.full(256, -1, np.int32)
        self.text: list[bytes] = [b""] * n
        self.score = np.full(n + 1, -np.inf)
        order: list[tuple[float, int]] = []
        pieces: dict[bytes, int] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
                order.append((math.inf, i))  # after all others
            elif not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)):
                self.text[i] = piece.replace(MARK, " ").encode()
                order.append((-sp.get_score(i), i))
                pieces[piece.replace(MARK, " ").encode()] = i
        if any(re.search(rb"[^ ] ", p) for p in pieces):
            raise ValueError("a piece has a marker after another character; chunks would not be exact")
        if (self.byte < 0).any():
            raise ValueError("the model has no byte fallback")
        share = 1 / (np.arange(len(order)) + ZIPF)
        self.score[[i for _, i in sorted(order)]] = np.log(share / share.sum())
        self.trie = Trie(pieces)
        inside = {p.decode() for p in pieces}
        #: pairs of characters that stand together in some piece
        self.pairs = {p[i : i + 2] for p in inside for i in range(len(p) - 1)}
        self.memo: dict[str, bytes] = {}
        self.memo_bytes = 0

    def __getstate__(self):
        return self.__dict__ | {"memo": {}, "memo_bytes": 0}

    def spelled(self, raw: bytes) -> bytes:
        """The bytes of a character that byte pieces stand for."""
        return MARK.encode() if raw == OWN else raw

    @cached_property
    def lists(self):
        return self.trie.base.tolist(), self.trie.check.tolist(), self.trie.leaf.tolist(), self.score.tolist()

    def viterbi_one(self, raw: bytes) -> np.ndarray:
        """As ``viterbi``, for one chunk, position by position."""
        base, check, leaf, score = self.lists
        n, top = len(raw), len(check)
        best, back, by = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            if best[i] == -math.inf or raw[i] & 0xC0 == 0x80:
                continue
            end = i + 1
            while end < n and raw[end] & 0xC0 == 0x80:
                end += 1
            state, at, covered = 0, i, False
            while at < n:
                nxt = base[state] + raw[at]
                if nxt >= top or check[nxt] != state:
                    break
                state, at = nxt, at + 1
                piece = leaf[state]
                if piece >= 0 and (at == n or raw[at] & 0xC0 != 0x80):
                    covered |= at == end
                    if best[i] + score[piece] > best[at]:
                        best[at], back[at], by[at] = best[i] + score[piece], i, piece
            if not covered:
                x = best[i] + sum(score[self.byte[c]] for c in self.spelled(raw[i:end]))
                if x > best[end]:
                    best[end], back[end], by[end] = x, i, -1
        return self._path(raw, n, back, by)

    def _path(self, raw: bytes, e: int, back, by) -> np.ndarray:
        ids: list[int] = []
        while e > 0:
            s = int(back[e])
            if by[e] >= 0:
                ids.append(int(by[e]))
            else:
                ids += [int(self.byte[c]) for c in reversed(self.spelled(raw[s:e]))]
            e = s
        return np.array(ids[::-1], "<u4")

    def viterbi(self, raws: list[bytes]) -> list[np.ndarray]:
        """Ids of each chunk: one forward pass over positions for all of them together."""
        n = len(raws)
        size = np.array([len(c) for c in raws])
        width = int(size.max()) if n else 0
        m = np.zeros((n, width + 1), np.uint8)
        flat = np.frombuffer(b"".join(raws), np.uint8)
        at = np.concatenate([[0], np.cumsum(size)])
        m[np.repeat(np.arange(n), size), np.arange(at[-1]) - np.repeat(at[:-1], size)] = flat
        head = (m & 0xC0) != 0x80  # bytes that start a character
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        back, by = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
        t, ends = self.trie, np.arange(width + 1) == size[:, None]
        stop = head | ends
        for i in range(width):
            rows = np.flatnonzero((best[:, i] > -np.inf) & (i < size) & head[:, i])
            if not len(rows):
                continue
            start, state, covered = best[rows, i], np.zeros(len(rows), np.int64), np.zeros(n, bool)
            live, d = rows, 0
            while len(live) and d < t.deepest and i + d < width:
                c = m[live, i + d]
                nxt = t.base[state] + c
                ok = (nxt < len(t.check)) & (i + d < size[live])
                ok[ok] = t.check[nxt[ok]] == state[ok]
                live, start, state = live[ok], start[ok], nxt[ok]
                d += 1
                hit = (t.leaf[state] >= 0) & stop[live, i + d]
                r, s = live[hit], t.leaf[state[hit]]
                x = start[hit] + self.score[s]
                up = x > best[r, i + d]
                r, s = r[up], s[up]
                best[r, i + d], back[r, i + d], by[r, i + d] = x[up], i, s
                if d <= 4:  # a piece of one character leaves no need for fallback
                    one = live[hit][head[live[hit], i + 1 : i + d].sum(axis=1) == 0] if d > 1 else live[hit]
                    covered[one] = True
            rest = rows[~covered[rows]]
            if len(rest):  # to the next character, spelled in bytes
                step = np.ones(len(rest), np.int64)
                for k in range(1, 4):
                    go = (step == k) & (i + k < size[rest]) & ~stop[rest, np.minimum(i + k, width)]
                    step[go] += 1
                x = best[rest, i].copy()
                for k in range(4):
                    x += np.where(k < step, self.score[self.byte[m[rest, np.minimum(i + k, width)]]], 0)
                own = m[rest, i] == OWN[0]
                x[own] = best[rest[own], i] + sum(self.score[self.byte[c]] for c in MARK.encode())
                up = x > best[rest, i + step]
                r, e = rest[up], (i + step)[up]
                best[r, e], back[r, e], by[r, e] = x[up], i, -1
        return [self._path(raws[k], int(size[k]), back[k], by[k]) for k in range(n)]

    def parts(self, chunk: str) -> list[str]:
        """Where no piece can cross, a long chunk is cut."""
        at = [0, *(i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in self.pairs), len(chunk)]
        return [chunk[i:j] for i, j in zip(at, at[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [[p for c in CHUNK.findall(" " + t) for p in (self.parts(c) if len(c) > LONG else (c,))] if t else [] for t in texts]
        memo = self.memo
        if self.memo_bytes > CACHE:
            memo.clear()
            self.memo_bytes = 0
        found: dict[str, bytes] = {}
        new = sorted({c for row in cut for c in row if c not in memo}, key=len)
        raw = [(c, c.encode("utf-8", "surrogatepass").replace(MARK.encode(), OWN)) for c in new]
        found = {c: self.viterbi_one(r).tobytes() for c, r in raw if len(r) > LONG}
        short = [(c, r) for c, r in raw if len(r) <= LONG]
        for i in range(0, len(short), 20_000):
            part = short[i : i + 20_000]
            for (c, _), ids in zip(part, self.viterbi([r for _, r in part]), strict=True):
                memo[c] = ids.tobytes()
                self.memo_bytes += len(c.encode("utf-8", "surrogatepass")) + len(memo[c]) + OVERHEAD
        return [np.frombuffer(b"".join([found[c] if c in found else memo[c] for c in row]), "<u4") for row in cut]

    def decode(self, ids) -> str:
        """Pieces with markers as blanks, byte pieces as bytes; the marker in front goes."""
        text = self.text
        return b"".join([text[i] for i in ids])[1:].decode("utf-8", "replace")


def encode_docs(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (array of int), decoded.

    Null and empty texts have no ids and decode to the empty string. Repeated rows and null ids
    stay. Other columns are not read. An empty table gives no rows. ``path``: a SentencePiece
    model with byte fallback, read by the driver (default: the installed 32k one)."""
    return _coded(docs, path, id_col, text_col, lambda i, ids, text, out: (i, ids, out), [pa.int64(), pa.list_(pa.int32()), pa.string()], "doc_id long, ids array<int>, decoded string")


def digest_docs(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_docs``, but digests: doc_id, n_pieces, ids_crc32 (little-endian unsigned 32-bit
    ids), decoded_sha256, round_trip."""
    row = lambda i, ids, text, out: (i, len(ids), zlib.crc32(ids.tobytes()), hashlib.sha256(out.encode()).hexdigest(), out == text)
    return _coded(docs, path, id_col, text_col, row, [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()], "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean")


def _coded(docs, path, id_col, text_col, row, kinds, schema):
    import public_tokenizers

    shared = docs.sparkSession.sparkContext.broadcast(Codec(path or public_tokenizers.path("piece_bpe_32k.model")))

    def run(batches):
        codec = shared.value
        names = [x.split()[0] for x in schema.split(", ")]
        for b in batches:
            _, off = text_bytes(b.column(1))
            for i, j in chunks(off, 1 << 20):
                part = b.slice(i, j - i)
                texts = [t or "" for t in part.column(1).to_pylist()]
                found = codec.encode(texts)
                rows = [row(k, ids, t, codec.decode(ids.tolist())) for k, ids, t in zip(part.column(0).to_pylist(), found, texts, strict=True)]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    base = id_text(docs, id_col, text_col)
    return base.mapInArrow(run, schema)
