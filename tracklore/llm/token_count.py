"""Edit-aware token counts: a segment tree of pre-tokens per document, mended where the text is edited.

A byte-level BPE tokenizer first cuts a text into pre-tokens by a pattern that only looks ahead, and then encodes each
alone. So a document's count is the sum over its pre-tokens, kept as the leaves (in blocks of ``BLOCK``) of a segment
tree whose nodes hold characters and tokens below them. An edit re-reads the text from the last pre-token boundary that
it cannot have moved (two characters before its start: the pattern looks no further) to the first one after its end
that the old text had as well; from there on all is as before. Sums are updated on the path to the root.

Defined cases: null and empty texts count 0; repeated rows and null ids are counted each; edits are half-open ranges of code
points, sorted and not overlapping (others raise an error); a null list of edits is an empty one. Extra columns are not read.

Scale: one pass where the texts lie, no shuffle. The tokenizer file (under 1 MB) is read by the driver and broadcast; the
cache of pre-token lengths in a task is bounded.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from tracklore.llm.common import map_chunks, table
from tracklore.llm.pii import base_spans

#: Default tokenizer: token bytes in base 64 and rank, a line each.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pre-token pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRE_TOKEN = regex.compile(PATTERN)
BLOCK = 64
#: Characters past its end that decide where a pre-token ends.
AHEAD = 2


class PieceCounts(dict):
    """Tokens of each pre-token."""

    def __init__(self, ranks: bytes):
        super().__init__()
        merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})

    def __missing__(self, piece: str) -> int:
        if len(self) > 500_000:
            self.clear()
        n = len(self.encoding.encode_ordinary(piece))
        if len(piece) < 64:
            self[piece] = n
        return n


@functools.lru_cache(maxsize=2)
def piece_counts(ranks: bytes) -> PieceCounts:
    return PieceCounts(ranks)


class TokenTree:
    """Blocks of pre-tokens (their characters and tokens) under a binary tree of sums; node 1 is the root."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.recoded = 0
        self._build(chars, tokens)

    @classmethod
    def of(cls, text: str, counts: PieceCounts) -> TokenTree:
        pieces = PRE_TOKEN.findall(text)
        return cls(np.fromiter(map(len, pieces), np.int32, len(pieces)), np.fromiter(map(counts.__getitem__, pieces), np.int32, len(pieces)))

    def _build(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        n = max(1, -(-len(chars) // BLOCK))
        self.blocks = [(chars[i * BLOCK : (i + 1) * BLOCK], tokens[i * BLOCK : (i + 1) * BLOCK]) for i in range(n)]
        self.width = 1 << (n - 1).bit_length()
        self.chars, self.tokens = np.zeros(2 * self.width, np.int64), np.zeros(2 * self.width, np.int64)
        starts = np.arange(0, len(chars), BLOCK)
        if len(chars):
            self.chars[self.width : self.width + n] = np.add.reduceat(chars, starts)
            self.tokens[self.width : self.width + n] = np.add.reduceat(tokens, starts)
        at = self.width
        while at > 1:
            half = at // 2
            for sums in (self.chars, self.tokens):
                sums[half:at] = sums[at : 2 * at].reshape(-1, 2).sum(1)
            at = half

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    @property
    def length(self) -> int:
        return int(self.chars[1])

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([b[0] for b in self.blocks]), np.concatenate([b[1] for b in self.blocks])

    def find(self, place: int) -> tuple[int, int, int]:
        """Block, index in it and start of the pre-token that holds this place (the last one, if it lies beyond)."""
        node, left = 1, min(max(place, 0), max(self.length - 1, 0))
        start = 0
        while node < self.width:
            node *= 2
            if left >= self.chars[node]:
                left -= int(self.chars[node])
                start += int(self.chars[node])
                node += 1
        block = min(node - self.width, len(self.blocks) - 1)
        ends = np.cumsum(self.blocks[block][0])
        k = int(np.searchsorted(ends, left, side="right"))
        return block, k, start + (int(ends[k - 1]) if k else 0)

    def _set(self, block: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.blocks[block] = (chars, tokens)
        node = self.width + block
        self.chars[node], self.tokens[node] = chars.sum(), tokens.sum()
        while node > 1:
            node //= 2
            for sums in (self.chars, self.tokens):
                sums[node] = sums[2 * node] + sums[2 * node + 1]

    def _replace(self, first: tuple[int, int], last: tuple[int, int], chars: list[int], tokens: list[int]) -> None:
        """Put new pre-tokens for those from first up to, without, last (block, index)."""
        (b0, k0), (b1, k1) = first, last
        head, tail = self.blocks[b0], self.blocks[b1]
        new = tuple(np.concatenate([h[:k0], np.array(x, np.int32), t[k1:]]) for h, x, t in zip(head, (chars, tokens), tail, strict=True))
        none = np.zeros(0, np.int32)
        for b in range(b0 + 1, b1 + 1):
            self._set(b, none, none)
        self._set(b0, *new)
        if len(new[0]) > 4 * BLOCK:
            self._build(*self.leaves())

    def edit(self, text: str, edits: Sequence[tuple[int, int, str]], counts: PieceCounts) -> str:
        """The edited text; the tree then stands for it. edits: (start, end, replacement) in code points of text."""
        parts, at = [], 0
        for s, e, r in edits:
            if not at <= s <= e <= len(text):
                raise ValueError("edits must be sorted, within the text and not overlap")
            parts += [text[at:s], r]
            at = e
        new = "".join([*parts, text[at:]])
        shift, k = 0, 0
        while k < len(edits):
            s, e, r = edits[k]
            block, index, place = self.find(s + shift - AHEAD)
            first = (block, index)
            end, ahead = s + shift + len(r), shift + len(r) - (e - s)
            k += 1
            chars, tokens = [], []
            old, cursor = place, [block, index]
            done = False
            for m in PRE_TOKEN.finditer(new, place):
                chars.append(m.end() - m.start())
                tokens.append(counts[m[0]])
                while k < len(edits) and edits[k][0] + ahead - AHEAD < m.end():
                    s, e, r = edits[k]
                    end = s + ahead + len(r)
                    ahead += len(r) - (e - s)
                    k += 1
                if m.end() >= end:
                    goal = m.end() - (ahead - shift)
                    old = self._advance(cursor, old, goal)
                    if old == goal:
                        done = True
                        break
            if not done:
                self._advance(cursor, old, self.length)
            self.recoded += len(chars)
            self._replace(first, (cursor[0], cursor[1]), chars, tokens)
            shift = ahead
        return new

    def _advance(self, cursor: list[int], place: int, goal: int) -> int:
        """Move the cursor over whole pre-tokens until its place reaches the goal."""
        while place < goal:
            sizes = self.blocks[cursor[0]][0]
            if cursor[1] >= len(sizes):
                if cursor[0] + 1 >= len(self.blocks):
                    break
                cursor[0], cursor[1] = cursor[0] + 1, 0
                continue
            place += int(sizes[cursor[1]])
            cursor[1] += 1
        return place


def tokenizer_file(path: str = TOKENIZER) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def build_trees(docs: DataFrame, ranks: bytes) -> DataFrame:
    """doc_id, n_tokens and the leaves of each document's tree (32-bit counts of characters and tokens), to be stored."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def work(batch: pa.RecordBatch):
        counts = piece_counts(shared.value)
        trees = [TokenTree.of(t or "", counts) for t in batch.column("text").to_pylist()]
        leaves = [t.leaves() for t in trees]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([t.total for t in trees], pa.int64()), *(pa.array([x[j].tobytes() for x in leaves], pa.binary()) for j in (0, 1))], names=["doc_id", "n_tokens", "leaf_chars", "leaf_tokens"])

    return map_chunks(docs.select("doc_id", "text"), work, "doc_id long, n_tokens long, leaf_chars binary, leaf_tokens binary")


def apply_edits(rows: DataFrame, ranks: bytes) -> DataFrame:
    """rows(doc_id, text, leaf_chars, leaf_tokens, edits array<struct<start,end,text>>) to the edited text, its tree and count."""
    shared = rows.sparkSession.sparkContext.broadcast(ranks)

    def work(batch: pa.RecordBatch):
        counts = piece_counts(shared.value)
        out = []
        for text, chars, tokens, edits in zip(*(batch.column(c).to_pylist() for c in ("text", "leaf_chars", "leaf_tokens", "edits")), strict=True):
            tree = TokenTree(np.frombuffer(chars or b"", np.int32), np.frombuffer(tokens or b"", np.int32))
            new = tree.edit(text or "", [(e["start"], e["end"], e["text"]) for e in edits or []], counts)
            out.append((new, tree.total, tree.recoded, *(x.tobytes() for x in tree.leaves())))
        types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array([o[j] for o in out], t) for j, t in enumerate(types))], names=["doc_id", "text", "n_tokens", "n_recoded", "leaf_chars", "leaf_tokens"])

    return map_chunks(rows.select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits"), work, "doc_id long, text string, n_tokens long, n_recoded long, leaf_chars binary, leaf_tokens binary")


def masking_edits(text: str) -> list[tuple[int, int, str]]:
    """The edits that mask e-mail addresses, IP addresses, cards and phone numbers."""
    out, at = [], 0
    for kind, s, e in sorted(base_spans(text), key=lambda x: (x[1], -x[2])):
        if s >= at:
            out.append((s, e, f"<{kind}>"))
            at = e
    return out


def count_before_and_after(docs: DataFrame, ranks: bytes) -> DataFrame:
    """Token counts of each document, and after its personal data are masked: the second through edits of the first's tree."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    names = ["doc_id", "n_chars", "n_pretokens", "n_tokens", "n_edits", "n_recoded", "n_tokens_after"]

    def work(batch: pa.RecordBatch):
        counts = piece_counts(shared.value)
        out = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            tree = TokenTree.of(text, counts)
            before, pieces = tree.total, sum(len(b[0]) for b in tree.blocks)
            edits = masking_edits(text)
            tree.edit(text, edits, counts)
            out.append((len(text), pieces, before, len(edits), tree.recoded, tree.total))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array([o[j] for o in out], pa.int64()) for j in range(6))], names=names)

    return map_chunks(docs.select("doc_id", "text"), work, ", ".join(f"{n} long" for n in names))


def op1_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_before_and_after(table(spark, sf_dir, "documents"), tokenizer_file())
