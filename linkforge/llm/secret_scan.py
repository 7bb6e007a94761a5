"""Secret scans: fixed patterns, and password guess-cost dynamic programming.

The value of each credential context is segmented at the smallest total cost (in bits) into
dictionary words, runs of letters that read as an unlisted word, dates, repeated blocks, keyboard
walks and brute-force spans. A value that takes at least ``LEAST_BITS`` to guess is a secret;
``changeme2024`` is not.

The dictionary is read from the installed public vocabularies (their paths are a parameter), the
most frequent words first, and shipped to tasks: its size is theirs, whatever the corpus.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
from collections import Counter
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, releasing, small_batches

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # of 20 characters or more; maximal runs, so the same spans
HEX = re.compile(r"[0-9a-f]{24,}")
#: Contexts that the fixed patterns leave out; the value is what the cost is computed of.
CONTEXT = re.compile(
    r"""(?:pwd|pass|passphrase|credentials?|private_?key|access_?key|client_?secret|auth_?key|bearer|password|passwd|secret|token|api_?key)["']?\x20*(?:[:=]{1,2}>?|\bis\b)\x20*["']?([^\s"'<>,;]{8,})""",
    re.I | re.A,
)
#: References to a value that is kept elsewhere: ${NAME}, $NAME, {{name}}, %NAME%.
ELSEWHERE = re.compile(r"\$?\{+\s*[\w.:-]+\s*\}+|\$[A-Za-z_]\w*|%[A-Za-z_]\w*%")
LEAST_BITS = 33.0
# Common words of passwords and configuration files; the vocabularies' words follow.
COMMON = (
    "password pass word admin root user login welcome letmein master dragon monkey shadow sunshine princess football baseball iloveyou "
    "trustno superman batman hello freedom whatever qwerty secret token key test testing demo example sample default change changeme "
    "your here none null true false todo placeholder dummy value string enter insert replace my the this that not real fake temp "
    "summer winter spring autumn monday friday january love hunter access api client server public private local prod dev stage"
).split()
VOCABULARIES = ("word_bpe_49k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d"
)
DATE_BITS = {4: math.log2(100), 8: math.log2(100 * 366), 10: math.log2(100 * 366 * 5)}
#: Bits of a walk's first key and length, of each change of its direction, and of the number of times
#: a block is repeated; longest such block.
WALK_BITS, TURN_BITS, REPEAT_BITS, PERIOD = 10.0, 2.0, 4.0, 16
#: An unlisted word of a language is a guess among about this many (in bits).
UNLISTED_BITS = 18.0
#: Most bits a letter, under the letter model, of a run of letters that reads as a word.
READABLE = 4.7
LETTERS = re.compile(r"[^\W\d_]+")
PROSE = re.compile(r"((?:[^\W\d_]+-)*[^\W\d_]+)[.!?:)\]]*")


def _steps() -> dict[str, frozenset]:
    """Directions of two characters that follow each other: along a row of the keyboard, to the row
    above or below (keys of a column, and the diagonal beside it), along the alphabet."""
    found: dict[str, set] = {}

    def put(a: str, b: str, way: str):
        found.setdefault(a + b, set()).add(way)

    rows = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
    for y, row in enumerate(rows):
        for x, a in enumerate(row):
            for dy, dx, way in ((0, 1, "right"), (1, 0, "down"), (1, -1, "down left")):
                if y + dy < len(rows) and 0 <= x + dx < len(rows[y + dy]):
                    b = rows[y + dy][x + dx]
                    put(a, b, way)
                    put(b, a, f"back {way}")
    for a, b in zip(map(chr, range(97, 122)), map(chr, range(98, 123)), strict=True):
        put(a, b, "next")
        put(b, a, "back next")
    put("0", "1", "right")
    put("9", "0", "right")
    put("1", "0", "back right")
    return {k: frozenset(v) for k, v in found.items()}


STEPS = _steps()


def char_bits(c: str) -> float:
    return math.log2(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 1000)


def vocabulary(paths: tuple[str, ...] | None = None) -> list[str]:
    """Words of three letters or more of BPE vocabularies (``tokenizers`` files with word ends, or rank
    files), lower case; each file is in the order of its merges, so frequent words come first, and
    files take turns."""
    import public_tokenizers

    rank: dict[str, int] = {}
    for path in paths or tuple(map(public_tokenizers.path, VOCABULARIES)):
        with open(path, "rb") as f:
            if path.endswith(".json"):
                entries = json.load(f)["model"]["vocab"]
                words = [w[:-4] for w in sorted(entries, key=entries.get) if w.endswith("</w>")]
            else:
                pairs = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, f))
                words = [t.decode("utf-8", "ignore")[1:] for _, t in pairs if t.startswith(b" ")]
        for i, w in enumerate(w for w in words if len(w) >= 3 and w.isalpha()):
            rank[w.lower()] = min(i, rank.get(w.lower(), i))
    return sorted(rank, key=lambda w: (rank[w], w))


class Guesser:
    """Guess costs under a ranked dictionary."""

    def __init__(self, words: list[str]):
        words = list(dict.fromkeys([*COMMON, *words]))
        self.rank = {w: i + 1 for i, w in enumerate(words)}
        self.longest = max(map(len, words))
        # counts of letters after their two predecessors, and of the predecessors
        self.after, self.before = Counter(), Counter()
        for w in words:
            x = f"^^{w}$"
            for i in range(2, len(x)):
                self.after[x[i - 2 : i + 1]] += 1
                self.before[x[i - 2 : i]] += 1

    def readable(self, run: str) -> bool:
        """Whether letters follow each other as in the listed words, on average."""
        if run not in (run.lower(), run.upper(), run.capitalize()):
            return False
        x = f"^^{run.lower()}$"
        bits = sum(math.log2((self.before[x[i - 2 : i]] + 15) / (self.after[x[i - 2 : i + 1]] + 0.2)) for i in range(2, len(x)))
        return bits <= READABLE * (len(x) - 2)

    def word_bits(self, part: str) -> float:
        """Of a listed word in any case; infinite for others."""
        r = self.rank.get(part.lower())
        if r is None:
            return math.inf
        case = 0.0 if part == part.lower() else 1.0 if part in (part.upper(), part.capitalize()) else float(len(part))
        return 1 + math.log2(r + 1) + case

    def bits(self, value: str, blocks: dict[str, float] | None = None) -> float:
        """Least total cost over all segmentations, exactly, by dynamic programming over end
        positions: each kind of span extends by recurrences, so the work is linear in the length.

        A brute-force span costs a bit and its characters'. A walk has three keys or more; changing
        direction costs ``TURN_BITS``. A repeat is a block of up to ``PERIOD`` characters two times or
        more (one character: three times), at the block's own cost. A run of six letters or more
        that reads as a word is one as a whole."""
        low, n = value.lower(), len(value)
        if len(low) != n:
            low = value
        blocks = {} if blocks is None else blocks
        best, brute = [0.0] + [math.inf] * n, math.inf
        dates: dict[int, list[float]] = {}
        runs = {m.end(): m.start() for m in LETTERS.finditer(value) if m.end() - m.start() >= 6 and self.readable(m[0])}
        walks: dict[str, float] = {}  # by direction: walks of two keys or more that end here
        repeats: list[dict[int, float]] = []  # at each position, by period: repeats that end there
        for i in range(1, n + 1):
            c = value[i - 1]
            if c.isdigit():
                for size, bits in DATE_BITS.items():
                    if i - 1 + size <= n and DATE.fullmatch(value, i - 1, i - 1 + size):
                        dates.setdefault(i - 1 + size, []).append(best[i - 1] + bits)
            brute = min(brute, best[i - 1] + 1.0) + char_bits(c)
            cost = min([brute, *dates.pop(i, ())])
            for w in range(1, min(self.longest, i) + 1):
                if low[i - w : i] in self.rank:
                    cost = min(cost, best[i - w] + self.word_bits(value[i - w : i]))
            if i in runs:
                cost = min(cost, best[runs[i]] + UNLISTED_BITS)
            here: dict[str, float] = {}
            if i > 1:
                turned = min(walks.values(), default=math.inf) + TURN_BITS
                for way in STEPS.get(low[i - 2 : i], ()):
                    longer = min(walks.get(way, math.inf), turned)
                    cost = min(cost, longer)
                    here[way] = min(longer, best[i - 2] + WALK_BITS)
            walks = here
            again: dict[int, float] = {}
            for p in range(1, min(PERIOD, i // 2) + 1):
                if value.startswith(value[i - p : i], i - 2 * p):
                    times = 3 if p == 1 else 2
                    got = repeats[i - p - 1].get(p, math.inf) if i > p else math.inf
                    if i >= times * p and value.startswith(value[i - p : i], i - times * p):
                        block = value[i - p : i]
                        if block not in blocks:
                            blocks[block] = self.bits(block, blocks) if p > 1 else 1.0 + char_bits(block)
                        got = min(got, best[i - times * p] + blocks[block] + REPEAT_BITS)
                    if got < math.inf:
                        again[p] = got
                        cost = min(cost, got)
            repeats.append(again)
            best[i] = cost
        return best[n]


@cache
def guesser(paths: tuple[str, ...] | None = None) -> Guesser:
    return Guesser(vocabulary(paths))


def scan(text: str, costs: Guesser) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, added spans), as start, end, kind, in order."""
    base = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    base += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    order = lambda x: (x[0], KINDS.index(x[2]))
    base.sort(key=order)
    more = []
    for m in CONTEXT.finditer(text):
        s, e = m.span(1)
        value = p[1] if (p := PROSE.fullmatch(m[1])) else m[1]  # words without the end of their sentence
        if not any(a < e and s < b for a, b, _ in base) and not ELSEWHERE.fullmatch(value) and costs.bits(value) >= LEAST_BITS:
            more.append((s, e, "guess"))
    return base, more


def spell(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redact(text: str, costs: Guesser) -> str:
    base, more = scan(text, costs)
    out, at = [], 0
    for s, e, kind in sorted([*base, *more]):
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]]) if out else text


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, ...] | None = None) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess.

    Null texts are empty: no spans, and the digest of the empty string. Repeated rows and null
    ids stay. Other columns are not read. An empty table gives no rows. ``paths``: vocabularies
    of the dictionary, read by the driver.
    """
    shared = docs.sparkSession.sparkContext.broadcast(guesser(paths))

    def run(batches):
        costs = shared.value
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                base, more = scan(t.as_py() or "", costs)
                n = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
                both = sorted([*base, *more], key=lambda x: (x[0], KINDS.index(x[2])))
                rows.append((i, *n, hashlib.sha256(spell(base).encode()).hexdigest(), spell(both), len(more)))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"])

    base = id_text(docs, id_col, text_col)
    return base.mapInArrow(releasing(run), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long")


def redact_docs(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", paths: tuple[str, ...] | None = None) -> DataFrame:
    """All rows and columns, with every secret's span replaced by its kind in brackets, and
    ``chars_col``, where there is one, the new length of changed texts. Null texts stay null, empty
    ones empty; repeated rows stay. An empty table gives no rows."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(guesser(paths))
    at = docs.columns.index(text_col)
    count = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def run(batches):
        costs = shared.value
        for b in batches:
            old = b.column(at).to_pylist()
            new = [t if t is None else redact(t, costs) for t in old]
            cols = list(b.columns)
            cols[at] = pa.array(new, b.schema.field(at).type)
            if count is not None:
                was = b.column(count).to_pylist()
                cols[count] = pa.array([w if a is c or a == c else len(c) for a, c, w in zip(old, new, was, strict=True)], b.schema.field(count).type)
            yield pa.record_batch(cols, schema=b.schema)

    return docs.mapInArrow(releasing(run), docs.schema)
