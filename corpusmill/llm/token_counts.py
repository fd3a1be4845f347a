"""Token counts by a compiled finite-state tokenizer.

Method. The vocabulary (BPE with word ends) is compiled, state by state as texts ask for them, into a deterministic transducer:

* BPE has the prefix property that the tokens of a prefix are the tokens of a shorter prefix and one last token, the
  only token that ends there and stands next to the one before it without merging with it. So a state needs, for each place from where
  a token may still be open, the last token there, the symbols since, and how many tokens fewer there were;
* a transition reads one byte (or the last byte of a word) and is annotated with the change of the token count, so the
  sum over a word's transitions is its token count. White space and other word ends lead back to the first state.

All words of a batch step through the transition table together (NumPy). A longer text is first turned into its stream of symbols (normalised
once, words cut by classes, blanks left out), which is cut into chunks. Any task makes a chunk's state map: which state and what count it
leads to from the state that it is entered in. After a word's last byte the state is the first one, whatever it was before, so a map is
the transitions up to there (its head, run from the state that comes in) and a constant behind: a count and the state at the end of the
chunk. Maps compose associatively, (state -> state, count) after (state -> state, count), so the maps of a text are scanned in order, in a
stream that holds one state, whichever tasks made them; only heads are run there, so the scan's work is a word a chunk.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import default_path

#: States that a compiled transducer holds before it is compiled anew (bounds the memory of a worker).
MAX_STATES = 120_000
#: Symbols of a chunk (and characters from which a text is cut into chunks), characters taken through NumPy at once.
CHUNK_CHARS, SLICE_CHARS = 1 << 13, 1 << 20
_loaded: dict[str, Transducer] = {}

#: White space of the tokenizer's patterns (the Unicode property), fixed values.
SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable Latin-1 as they are, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Transducer:
    """Symbols 0..255 are bytes inside a word, 256..511 last bytes of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        end = model["end_of_word_suffix"]

        def symbols(token: str) -> tuple[int, ...]:
            last = token.endswith(end) and token != end
            body = [letters[c] for c in (token[: -len(end)] if last else token)]
            return tuple(body[:-1] + [body[-1] + 256]) if last else tuple(body)

        self.special = [t["content"] for t in spec["added_tokens"]]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(symbols(a), symbols(b)): k for k, (a, b) in reversed(list(enumerate(merges)))}
        #: Children of every proper prefix of a token: symbol -> node; a token's node carries its symbols.
        self.child: list[dict[int, int]] = [{}]
        self.token: list[tuple[int, ...] | None] = [None]
        for t in model["vocab"]:
            node = 0
            for s in symbols(t):
                nxt = self.child[node].get(s)
                if nxt is None:
                    nxt = self.child[node][s] = len(self.child)
                    self.child.append({})
                    self.token.append(None)
                node = nxt
            self.token[node] = symbols(t)
        # tokens that BPE doesn't make of their own symbols never occur
        for k, t in enumerate(self.token):
            if t is not None and len(t) > 1 and len(self.merge(t)) != 1:
                self.token[k] = None
        self.apart: dict[tuple, bool] = {}
        self.clear()

    def merge(self, symbols: tuple[int, ...]) -> list[tuple[int, ...]]:
        """Plain BPE: the pair of least rank first, from the left."""
        parts = [(s,) for s in symbols]
        while len(parts) > 1:
            best = min(((self.rank.get((a, b), 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 30:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def stay_apart(self, a: tuple[int, ...], b: tuple[int, ...]) -> bool:
        known = self.apart.get((a, b))
        if known is None:
            if len(self.apart) > 500_000:
                self.apart.clear()
            known = self.apart[a, b] = self.merge(a + b) == [a, b]
        return known

    def clear(self) -> None:
        """Back to the first state alone: nothing before it, no open token."""
        self.states: list[tuple] = [((0, (), 0),)]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.column = np.full(512, -1, np.int64)  # of a symbol that has occurred
        self.used = 0
        self.next = np.full((1024, 64), -1, np.int32)
        self.emit = np.zeros((1024, 64), np.int8)

    def columns(self, symbols: np.ndarray) -> np.ndarray:
        """The table's column of each symbol; new symbols get new ones."""
        for s in np.unique(symbols[self.column[symbols] < 0]):
            self.column[s] = self.used
            self.used += 1
        self._grow(0, self.used - self.next.shape[1])
        return self.column[symbols]

    def _grow(self, rows: int, columns: int) -> None:
        if rows > 0 or columns > 0:
            wide = ((0, max(0, rows)), (0, max(0, columns)))
            self.next, self.emit = np.pad(self.next, wide, constant_values=-1), np.pad(self.emit, wide)

    def step(self, state: int, symbol: int) -> None:
        """Compile one transition. A state's items: (node of what is open, last token before it, tokens fewer than now)."""
        grown, options = [], []
        for node, before, fewer in self.states[state]:
            nxt = self.child[node].get(symbol)
            if nxt is not None:
                grown.append((nxt, before, fewer))
                t = self.token[nxt]
                if t is not None:
                    options.append((len(t), t, before, fewer))
        for _, t, before, fewer in sorted(options, reverse=True):
            if not before or self.stay_apart(before, t):
                break
        change = 1 - fewer
        if symbol >= 256:
            to = 0
        else:
            items = tuple(sorted([(n, b, f + change) for n, b, f in grown if self.child[n]] + [(0, t, 0)]))
            to = self.number.get(items)
            if to is None:
                to = self.number[items] = len(self.states)
                self.states.append(items)
                if to == len(self.next):
                    self._grow(min(to, 1 << 14), 0)
        self.next[state, self.column[symbol]] = to
        self.emit[state, self.column[symbol]] = change

    def run(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Token counts of the words at start (all at once; each ends with a symbol of 256 or more)."""
        if len(self.states) > MAX_STATES:
            self.clear()
        columns = self.columns(symbols)
        order = np.argsort(-length, kind="stable")
        at, left = start[order], length[order]
        state, count = np.zeros(len(at), np.int32), np.zeros(len(at), np.int64)
        steps = int(left[0]) if len(left) else 0
        active = np.searchsorted(-left, -np.arange(steps), side="left")  # words longer than the step
        for k in range(steps):
            m = active[k]
            sym = columns[at[:m] + k]
            to = self.next[state[:m], sym]
            new = np.flatnonzero(to < 0)
            if len(new):
                for pair in np.unique(state[new].astype(np.int64) * 512 + symbols[at[new] + k]):
                    self.step(int(pair) // 512, int(pair) % 512)
                to = self.next[state[:m], sym]
            count[:m] += self.emit[state[:m], sym]
            state[:m] = to
        out = np.empty_like(count)
        out[order] = count
        return out

    def walk(self, state: int, symbols: np.ndarray) -> tuple[int, int]:
        """(state, count) after the symbols, one after the other, from any state."""
        count = 0
        for symbol, column in zip(symbols.tolist(), self.columns(symbols).tolist()):
            if self.next[state, column] < 0:
                self.step(state, symbol)
            count += int(self.emit[state, column])
            state = int(self.next[state, column])
        return state, count

    def name_of(self, state: int) -> bytes:
        """What a state is in any process: its items."""
        return json.dumps(self.states[state]).encode()

    def state_of(self, name: bytes) -> int:
        """The number of a named state in this process."""
        if len(self.states) > MAX_STATES:
            self.clear()
        items = tuple((node, tuple(before), fewer) for node, before, fewer in json.loads(name))
        state = self.number.get(items)
        if state is None:
            state = self.number[items] = len(self.states)
            self.states.append(items)
            if state == len(self.next):
                self._grow(min(state, 1 << 14), 0)
        return state

    def pieces(self, text: str) -> list[str]:
        """The text between special strings, normalised; each special string is a token of its own."""
        parts = [text]
        for s in self.special:
            if s in text:
                parts = [x for p in parts for x in p.split(s)]
        return [normalized(p) for p in parts]

    def stream(self, text: str) -> tuple[int, np.ndarray]:
        """(number of special strings, symbols of all words in order) of a text of any length."""
        parts, out = self.pieces(text), []
        for p in parts:
            at = 0
            while at < len(p):
                cut = _last_blank(p, at, at + SLICE_CHARS)
                symbols, inside, *_ = self._symbols([p[at:cut]])
                out.append(symbols[inside].astype(np.int16))
                at = cut
        return len(parts) - 1, np.concatenate([*out, np.zeros(0, np.int16)])

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, special strings inside counted as the tokens that they are."""
        pieces, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            parts = self.pieces(t)
            extra[k] = len(parts) - 1
            pieces += parts
            owner += [k] * len(parts)
        out = extra
        if pieces:
            np.add.at(out, np.array(owner), self._words(pieces))
        return out

    def _words(self, pieces: list[str]) -> np.ndarray:
        """Token counts of normalised pieces, all run through the table at once."""
        symbols, _, start, length, place = self._symbols(pieces)
        per = np.zeros(len(pieces), np.int64)
        if len(start):
            np.add.at(per, place, self.run(symbols, start, length))
        return per

    def _symbols(self, pieces: list[str]) -> tuple[np.ndarray, ...]:
        """(symbols, which of them stand in words, start and length of each word, its piece) of normalised pieces: cut into words by classes, into symbols by UTF-8."""
        joined = " ".join(pieces) + " "
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(np.array([len(p) + 1 for p in pieces], np.int64))
        kind = _class_table()[points]
        begins = np.empty(len(points), bool)
        begins[0] = kind[0] != BLANK
        begins[1:] = (kind[1:] != BLANK) & ((kind[1:] == NUMBER) | (kind[1:] != kind[:-1]))
        # 's 't 're 've 'm 'll 'd: only where the apostrophe is a run of its own
        for q in np.flatnonzero(points == 39):
            if kind[q + 1] != LETTER or (q and kind[q - 1] == OTHER and not begins[q]):
                continue
            two = joined[q + 1 : q + 3]
            n = 1 if two[:1] in ("s", "t", "m", "d") else 2 if two in ("re", "ve", "ll") else 0
            if n:
                begins[q + 1] = False
                if n == 2:
                    begins[q + 2] = False
                if kind[q + 1 + n] == LETTER:
                    begins[q + 1 + n] = True
        raw = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        wide = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        byte_at = np.cumsum(wide) - wide
        symbols, inside = raw.astype(np.int32), np.repeat(kind != BLANK, wide)
        first = np.flatnonzero(begins)
        if not len(first):
            return symbols, inside, first, first, first
        # a word ends before the next begin or the next blank
        stop = np.flatnonzero(begins | (kind == BLANK))
        end = np.append(stop, len(points) - 1)[np.searchsorted(stop, first, side="right")]
        start, finish = byte_at[first], byte_at[end]
        symbols[finish - 1] += 256
        return symbols, inside, start, finish - start, np.searchsorted(ends, first, side="right")


_table: list[np.ndarray] = []


def _class_table() -> np.ndarray:
    if not _table:
        kinds = {"L": LETTER, "N": NUMBER}
        t = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.int8)
        t[[ord(c) for c in SPACE]] = BLANK
        _table.append(t)
    return _table[0]


def normalized(text: str) -> str:
    """Composed (NFC) and lower-cased letter by letter (the library has no rule for a sigma at the end of a word)."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            return "".join(c.lower() for c in text)
    return text.lower()


def load(path: str) -> Transducer:
    if path not in _loaded:
        _loaded[path] = Transducer(path)
    return _loaded[path]


def _last_blank(text: str, at: int, end: int) -> int:
    """A cut behind a blank, at `end` or before it; without a blank in between, behind the next one or at the end of the text."""
    if end >= len(text):
        return len(text)
    last = max(text.rfind(c, at, end) for c in SPACE)
    if last < 0:
        last = next((k for k in range(end, len(text)) if text[k] in SPACE), len(text) - 1)
    return last + 1


#: A state map: symbols to run from the state that comes in, up to the first end of a word; then the count and the name of the state behind
#: them (None where no word ends in the chunk: the map is its head alone).
StateMap = tuple[np.ndarray, int, bytes | None]


def chunk_maps(counter: Transducer, chunks: list[np.ndarray]) -> list[StateMap]:
    """The state maps of chunks of symbols; their whole words run through the table at once."""
    flat = np.concatenate([*chunks, np.zeros(0, np.int16)]).astype(np.int32)
    edge = np.cumsum([0, *map(len, chunks)])
    ends = np.flatnonzero(flat >= 256) + 1
    at = np.searchsorted(ends, edge[:-1], side="right"), np.searchsorted(ends, edge[1:], side="right")  # ends inside each chunk
    owner = np.repeat(np.arange(len(chunks)), at[1] - at[0])
    whole = np.flatnonzero(owner[1:] == owner[:-1]) if len(ends) else np.zeros(0, np.int64)  # words between two ends of one chunk
    count = np.zeros(len(chunks), np.int64)
    if len(whole):
        np.add.at(count, owner[whole], counter.run(flat, ends[whole], ends[whole + 1] - ends[whole]))
    out: list[StateMap] = []
    for k, chunk in enumerate(chunks):
        if at[0][k] == at[1][k]:
            out.append((chunk, 0, None))
            continue
        head, tail = ends[at[0][k]] - edge[k], ends[at[1][k] - 1] - edge[k]
        state, n = counter.walk(0, chunk[tail:].astype(np.int64))
        out.append((chunk[:head], int(count[k]) + n, counter.name_of(state)))
    return out


def enter(counter: Transducer, state: bytes, m: StateMap) -> tuple[bytes, int]:
    """(state, count) behind a chunk that is entered in `state`."""
    to, n = counter.walk(counter.state_of(state), m[0].astype(np.int64))
    return (counter.name_of(to), n) if m[2] is None else (m[2], n + m[1])


def compose(counter: Transducer, a: StateMap, b: StateMap) -> StateMap:
    """The map of two chunks, one after the other (associative)."""
    if a[2] is None:
        return np.concatenate([a[0], b[0]]), b[1], b[2]
    state, n = enter(counter, a[2], b)
    return a[0], a[1] + n, state


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 2048, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """docs' doc_id with n_bytes, n_tokens and over_limit (n_tokens > limit).

    Null texts count as empty. Texts up to chunk_chars are counted where they are read; the symbols of longer ones are cut into chunks
    of that many, whose state maps any tasks make and which are then scanned in order. Each row of docs gives a row, repeated ids too; null ids stay.
    """
    path = path or default_path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long")
    fits = F.char_length("text") <= chunk_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch in batches:
            at = 0
            lens = batch.column(1).to_numpy()
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(np.cumsum(lens[at:]), 3_000_000, side="right")) + at)
                n = counter.count(batch.column(2)[at:end].to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:end], batch.column(1)[at:end], pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])
                at = end

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch in batches:
            for r in range(batch.num_rows):
                extra, symbols = counter.stream(batch.column(3)[r].as_py())
                for a in range(0, max(1, len(symbols)), chunk_chars * 64):
                    chunks = [symbols[b : b + chunk_chars].tobytes() for b in range(a, min(a + chunk_chars * 64, len(symbols)), chunk_chars)] or [b""]
                    at = pa.array(np.full(len(chunks), r))
                    k = np.arange(len(chunks)) + a // chunk_chars
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(3)), pa.array(k.astype(np.int32)), pa.array(np.where(k == 0, extra, 0)), pa.array(chunks, pa.binary())], ["row", "doc_id", "n_bytes", "k", "extra", "symbols"])

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                head, count, state = zip(*chunk_maps(counter, [np.frombuffer(x, np.int16) for x in part.column(5).to_pylist()]))
                count = pa.array(np.array(count, np.int64) + part.column(4).to_numpy())
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array([h.tobytes() for h in head], pa.binary()), count, pa.array(state, pa.binary())], ["row", "doc_id", "n_bytes", "k", "head", "count", "state"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        first = counter.name_of(0)
        row, held, state, total = None, None, first, 0
        for batch in batches:
            done = []
            for r, doc, n_bytes, _, head, count, to in zip(*(c.to_pylist() for c in batch.columns)):
                if r != row:
                    if held:
                        done.append((*held, total))
                    row, held, state, total = r, (doc, n_bytes), first, 0
                state, n = enter(counter, state, (np.frombuffer(head, np.int16), count, to))
                total += n + (count if to is None else 0)
            if done:
                yield _counted(done)
        if held:
            yield _counted([(*held, total)])

    short = rows.where(fits).select("doc_id", size.alias("n_bytes"), "text").mapInArrow(whole, "doc_id long, n_bytes long, n_tokens long")
    long = rows.where(~fits).select(F.monotonically_increasing_id().alias("row"), "doc_id", size.alias("n_bytes"), "text")
    parts = long.mapInArrow(cut, "row long, doc_id long, n_bytes long, k int, extra long, symbols binary").repartition("row", "k")
    made = parts.mapInArrow(maps, "row long, doc_id long, n_bytes long, k int, head binary, count long, state binary")
    longs = made.repartition("row").sortWithinPartitions("row", "k").mapInArrow(scan, "doc_id long, n_bytes long, n_tokens long")
    return short.unionByName(longs).withColumn("over_limit", F.col("n_tokens") > limit)


def _counted(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "n_bytes", "n_tokens"])


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
