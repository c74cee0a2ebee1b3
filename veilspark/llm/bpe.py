"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

A sequence of tokens is the BPE encoding of its bytes exactly when each token encodes to itself and
each adjacent pair encodes to that pair; so every prefix of a text has one encoding, given by its
last token and that of a shorter prefix. Encoding is a nondeterministic transducer whose hypotheses
are the places at which the next token may have begun: the suffixes of the bytes read that begin some
token. Determinising it keeps the longest such suffix (a node of the tokens' trie, whose suffix links
give the others) and the last tokens of the prefixes that these hypotheses rest on; the tokens that
all of them agree on are emitted. Suffixes are no longer than the longest token, which bounds the
lookahead. States and transitions are made when first met and remembered, up to a limit.

Decoding gathers the tokens' bytes and feeds them, in blocks, to a UTF-8 state machine that holds back
an incomplete character until its last byte has come.

Defined cases: a null or empty text has no ids; an empty table gives an empty result; ranks are read on
the driver from a path and sent to the tasks (a vocabulary is of fixed size); whole texts are encoded,
however long; rows with equal or null ids each alone; other columns are not read, so their names can't
clash.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from veilspark.llm.arrow import held, small_batches
from veilspark.llm.pieces import BatchEncoder, ragged, slices, split_pattern
from veilspark.plans.frames import read_table

#: Tokens decoded at once; pieces of a generation of remembered ones.
BLOCK, PIECES = 4096, 70_000
#: Bounds of what a worker remembers: parts of texts, and states of the transducer. Results don't depend on
#: them; ROOMY, about 100 MB more a worker, is for a job that has the executor's memory to itself.
MEMORY, ROOMY = (250_000, 120_000), (600_000, 300_000)


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], most_states: int = 120_000) -> None:
        self.ranks, self.most_states = ranks, most_states
        self.token = {r: t for t, r in ranks.items()}
        self.size = [0] * (max(ranks.values(), default=0) + 1)
        for t, r in ranks.items():
            self.size[r] = len(t)
        # A trie of all tokens: node * 256 + byte -> node; ends: node -> token.
        self.below: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        self.parent, self.depth = [0], [0]
        for token, rank in ranks.items():
            at = 0
            for byte in token:
                to = self.below.get(at << 8 | byte)
                if to is None:
                    to = self.below[at << 8 | byte] = len(self.parent)
                    self.parent.append(at << 8 | byte)
                    self.depth.append(self.depth[at] + 1)
                at = to
            self.ends[at] = rank
        self.links: dict[int, int] = {0: 0}
        self.inner = {above >> 8 for above in self.parent}  # nodes that longer tokens go on from
        self.suffixes: dict[int, tuple[int, tuple[int, ...], int]] = {0: (1, (), 0)}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        # A state: trie node; last token of the prefix all agree on, or -1 for none; last token of each longer prefix, longest first.
        # Tokens that no hypothesis rests on are 0.
        start = (0, -1, ())
        self.states: dict[tuple, int] = {start: 0}
        self.kept: list[tuple[int, int, tuple[int, ...]]] = [start]
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}  # by state * 256 + byte

    def _goto(self, node: int, byte: int) -> int:
        """The longest suffix of node's bytes and this one that begins a token."""
        below = self.below
        while (to := below.get(node << 8 | byte)) is None:
            if not node:
                return 0
            node = self._link(node)
        return to

    def _link(self, node: int) -> int:
        """The longest proper suffix of the node's bytes that begins a token."""
        found = self.links.get(node)
        if found is None:
            above, byte = self.parent[node] >> 8, self.parent[node] & 255
            found = self.links[node] = self._goto(self._link(above), byte) if above else 0
        return found

    def _suffixes(self, node: int) -> tuple[int, tuple[int, ...], int]:
        """Lengths of suffixes that begin a longer token, as bits (0 among them); suffixes that are tokens, longest
        first; and the node of the longest suffix that begins a longer token."""
        found = self.suffixes.get(node)
        if found is None:
            bits, tokens, inner = self._suffixes(self._link(node))
            if (token := self.ends.get(node)) is not None:
                tokens = (token, *tokens)
            if node in self.inner:
                bits, inner = bits | 1 << self.depth[node], node
            found = self.suffixes[node] = bits, tokens, inner
        return found

    def merges(self, data: bytes, below: int = 1 << 60) -> list[bytes]:
        """BPE as it is defined: the adjacent pair of lowest rank (under `below`) is merged until none is left."""
        got = [data[i : i + 1] for i in range(len(data))]
        rank = self.ranks.get
        while len(got) > 1:
            best, at = min((rank(a + b, below), i) for i, (a, b) in enumerate(zip(got, got[1:], strict=False)))
            if best >= below:
                break
            got[at : at + 2] = [got[at] + got[at + 1]]
        return got

    def made_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, or a token no merge makes."""
        if token not in self.halves:
            got = self.merges(self.token[token], token)
            self.halves[token] = (self.ranks[got[0]], self.ranks[got[1]]) if len(got) == 2 else None
        return self.halves[token]

    def stands_alone(self, token: int) -> bool:
        return len(self.token[token]) == 1 or self.made_of(token) is not None

    def compatible(self, a: int, b: int) -> bool:
        """Whether the two tokens' bytes encode to just these two.

        The merges next to the border are undone, latest first. If the tokens that then touch it
        would merge before the merge undone last, BPE would have merged across the border.
        """
        key = a << 20 | b
        if a < 0 or not self.stands_alone(b):
            self.pairs[key] = known = self.stands_alone(b)
            return known
        if (known := self.pairs.get(key)) is not None:
            return known
        if len(self.pairs) > 200_000:
            self.pairs.clear()
        token, rank = self.token, self.ranks.get
        before = 1 << 60  # only merges of lower rank, or of this rank further left, come first
        while True:
            across = rank(token[a] + token[b])
            if across is not None and across < before:
                known = False
                break
            left, right = self.made_of(a), self.made_of(b)
            if left is None and right is None:
                known = True
                break
            if right is None or (left is not None and a > b):
                before, a = a, left[1]
            else:
                # a merge of the same rank across the border lies further left, so it comes first
                before, b = b + 1, right[0]
        self.pairs[key] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        node, before, lasts = self.kept[state]
        to = self._goto(node, byte)
        bits, ending, node = self.suffixes.get(to) or self._suffixes(to)
        size, pairs, n = self.size, self.pairs, len(lasts)
        for token in ending:  # one of them continues the encoding of the prefix before it
            length = size[token]
            last = lasts[length - 1] if length <= n else before
            fits = pairs.get(last << 20 | token)
            if fits is None:
                fits = self.compatible(last, token)
            if fits:
                break
        else:
            raise ValueError(f"byte {byte} has no token")
        lasts = (token, *lasts)
        n += 1
        # Prefixes by their distance from here: those of the hypotheses, then those they rest on, until one is left.
        needed = open_ = bits
        while True:
            rest = open_ & open_ - 1
            at = (open_ ^ rest).bit_length() - 1
            if not rest:
                break
            more = 1 << at + size[lasts[at]]
            open_ = rest | more
            needed |= more
        emitted: tuple[int, ...] = ()
        if at < n:
            agreed, k = [], at
            while k < n:
                agreed.append(lasts[k])
                k += size[lasts[k]]
            before, emitted = agreed[0], tuple(agreed[::-1])
            lasts = lasts[:at]
        if not bits >> at & 1:
            before = 0  # no hypothesis begins where all agree
        if needed + 1 != 2 << at:
            lasts = tuple([t if needed >> k & 1 else 0 for k, t in enumerate(lasts)])
        key = (node, before, lasts)
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = len(self.kept)
            self.kept.append(key)
        self.moves[state << 8 | byte] = found = (to, emitted)
        return found

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece. A piece that is a token is that token, as the vocabulary's library has it."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(self.kept) > self.most_states:
            self._forget()
        out: list[int] = []
        moves, state = self.moves, 0
        for byte in piece:
            found = moves.get(state << 8 | byte)
            if found is None:
                found = self._step(state, byte)
            state, emitted = found
            if emitted:
                out += emitted
        lasts, tail = self.kept[state][2], []
        k = 0
        while k < len(lasts):
            tail.append(lasts[k])
            k += self.size[lasts[k]]
        return out + tail[::-1]


class Utf8Stream:
    """Bytes in any blocks to text: bytes of an incomplete last character wait for the next block.

    States: 0 between characters; n > 0: n more continuation bytes must come; `low` and `high` bound
    the next one, which rules out overlong forms, surrogates and values above U+10FFFF.
    """

    def __init__(self) -> None:
        self.held = b""
        self.need, self.low, self.high = 0, 0x80, 0xBF

    def _take(self, byte: int) -> None:
        if self.need:
            if not self.low <= byte <= self.high:
                raise UnicodeDecodeError("utf-8", bytes((byte,)), 0, 1, "invalid continuation byte")
            self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
        elif byte >= 0x80:
            if not 0xC2 <= byte <= 0xF4:
                raise UnicodeDecodeError("utf-8", bytes((byte,)), 0, 1, "invalid start byte")
            self.need = 1 + (byte >= 0xE0) + (byte >= 0xF0)
            self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
            self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)

    def feed(self, block: bytes) -> str:
        # Only bytes from the last start byte on can be incomplete; what is before is decoded as a whole.
        data = self.held + block
        start = len(data)
        for back in range(1, min(4, len(data)) + 1):
            if data[-back] & 0xC0 != 0x80:
                start = len(data) - back
                break
        else:
            start = max(0, len(data) - 4) if len(data) < 4 else len(data)
        self.need, self.low, self.high = 0, 0x80, 0xBF
        for byte in data[start:]:
            self._take(byte)
        whole = len(data) if self.need == 0 else start
        self.held = data[whole:]
        return data[:whole].decode("utf-8")

    def end(self) -> None:
        if self.held:
            raise UnicodeDecodeError("utf-8", self.held, 0, len(self.held), "unexpected end of data")


class Codec:
    """Encoding and decoding with one vocabulary, for one Python worker."""

    def __init__(self, content: bytes, pattern: str, memory: tuple[int, int] = MEMORY) -> None:
        ranks = parse_ranks(content)
        self.transducer = Transducer(ranks, memory[1])
        self.findall = split_pattern(pattern).findall
        # Ids of pieces met lately, in two generations: when the younger is full, the older goes.
        self.pieces: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.batches = BatchEncoder(self._encode, memory[0])
        # Bytes of all tokens one after another, and where each one's begin.
        order = sorted(ranks.values())
        sizes = np.zeros(order[-1] + 1 if order else 0, np.int64)
        sizes[order] = np.array(self.transducer.size)[order]
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(map(self.transducer.token.__getitem__, order)), np.uint8)

    def _encode(self, parts: list[str]) -> tuple[list[int], list[int]]:
        """Ids of the parts, one after another, and how many each has."""
        if len(self.pieces) > PIECES:
            self.older, self.pieces = self.pieces, {}
        known, older, findall, run = self.pieces, self.older, self.findall, self.transducer.encode
        flat: list[int] = []
        sizes = []
        for part in parts:
            before = len(flat)
            for piece in findall(part):
                got = known.get(piece)
                if got is None:
                    got = older.get(piece)
                    known[piece] = got = run(piece.encode()) if got is None else got
                flat += got
            sizes.append(len(flat) - before)
        return flat, sizes

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        return self.batches.encode(pa.array([text]))[0]

    def decode(self, ids: np.ndarray) -> Iterator[str]:
        """The text of ids, block by block."""
        stream = Utf8Stream()
        for i in range(0, len(ids), BLOCK):
            some = ids[i : i + BLOCK]
            yield stream.feed(self.bytes[ragged(self.starts[some], self.sizes[some])].tobytes())
        stream.end()


def codec(content: bytes, pattern: str, memory: tuple[int, int] = MEMORY) -> Codec:
    """This worker's codec, made once for each vocabulary."""
    return held(("bpe", hashlib.sha256(content + pattern.encode()).digest(), memory), lambda: Codec(content, pattern, memory))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's id and its token ids (array of long)."""
    content = read_ranks(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(content, pattern)
        for batch in batches:
            for some in slices(batch, 1):
                ids, ends = use.batches.encode(some.column(1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_arrays([some.column(0), lists], ["id", "ids"])

    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return small_batches(slim).mapInArrow(run, f"id {dict(slim.dtypes)['id']}, ids array<bigint>")


def digests(use: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, ends = use.batches.encode(batch.column(1))
    ids = ids.astype("<u4", copy=False)
    ids_sha, decoded_sha = [], []
    for start, end in itertools.pairwise(ends.tolist()):
        digest = hashlib.sha256()
        for block in use.decode(ids[start:end]):
            digest.update(block.encode())
        ids_sha.append(hashlib.sha256(ids[start:end].tobytes()).hexdigest())
        decoded_sha.append(digest.hexdigest())
    columns = [batch.column(0), pa.array(np.diff(ends), pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", memory: tuple[int, int] = MEMORY
) -> DataFrame:
    """Each document's number of tokens, digest of its ids, and digest of the text decoded from them."""
    content = read_ranks(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(content, pattern, memory)
        for batch in batches:
            for some in slices(batch, 1):
                yield digests(use, some)

    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"id {dict(slim.dtypes)['id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return small_batches(slim).mapInArrow(run, schema)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return round_trip(docs, *default_vocabulary(), memory=ROOMY).withColumnRenamed("id", "doc_id")
