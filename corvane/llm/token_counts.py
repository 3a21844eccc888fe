"""Token counts with edit-aware recounting.

A document is cut into pre-tokens by the tokenizer's splitting pattern, and as byte-pair merges
never cross them, its token count is the sum of theirs. The counts are the leaves of a segment
tree. An edit replaces a range of code points: only pre-tokens that touch the range, and boundary
context around it, are cut and encoded again; the new leaves take the place of the old ones and
the sums above them are updated.

Boundary context: where a pre-token ends depends only on the text from its start to two characters
beyond its end (a run of white space leaves its last blank to the next word). So cutting starts
`BACK` = 2 pre-tokens before the one that holds the edit's start, and stops at the first cut
behind the edit that the old text had too: from there both are the same text, cut from the same
place.

The tree is a B+ tree whose leaves hold up to `LEAVES` pre-tokens, their lengths, counts and text, and
whose inner nodes hold up to `FAN` children and the sums of code points, tokens, pre-tokens and
leaves below them. An edit takes new leaves in along one path, so its cost is the text that it
touches and the logarithm of the document's length; neither the text nor the sums are copied.

Trees are kept per document as a table (`build_trees`: the leaves in arrays), and `apply_edits` takes a
table of edits to it and gives the next one. The query counts every document as it is, then again
after a fixed edit script of the corpus (`edits_of`: each e-mail address is masked), by re-encoding
the touched regions only.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.idsets import suspects
from corvane.llm.words import ROWS_OUT
from corvane.session import bounded_batches, checkpointed
from corvane.sources.tables import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern that belongs to this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pattern for ASCII texts, for the faster engine.
ASCII_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Pre-tokens before an edit that are cut again with it.
BACK = 2
#: Pre-tokens of a leaf and children of an inner node of the tree, at most.
LEAVES, FAN = 64, 16
#: Pre-tokens whose counts a worker remembers.
REMEMBERED = 500_000

EMAIL = regex.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
MASK = "<EMAIL>"


class Counter(dict):
    """pre-token -> its number of tokens, remembered."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.cut = regex.compile(PATTERN)
        self.cut_ascii = re.compile(ASCII_PATTERN)
        self.encoding = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = len(self.encoding.encode_ordinary(piece))
        if len(piece) < 64:  # longer ones hardly come again
            self[piece] = value
        return value

    def pieces(self, text: str) -> list[str]:
        return (self.cut_ascii if text.isascii() else self.cut).findall(text)


def load_ranks(lines: list[bytes]) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}


class Leaf:
    __slots__ = ("chars", "leaves", "lengths", "pieces", "text", "tokens", "total")

    def __init__(self, text: str, lengths: list[int], tokens: list[int]):
        self.text, self.lengths, self.tokens = text, lengths, tokens
        self.chars, self.total, self.pieces, self.leaves = len(text), sum(tokens), len(lengths), 1


class Inner:
    __slots__ = ("chars", "children", "leaves", "pieces", "total")

    def __init__(self, children: list):
        self.children = children
        self.chars = sum(c.chars for c in children)
        self.total = sum(c.total for c in children)
        self.pieces = sum(c.pieces for c in children)
        self.leaves = sum(c.leaves for c in children)


def _cut_leaves(text: str, lengths: list[int], tokens: list[int]) -> list[Leaf]:
    leaves, at = [], 0
    for k in range(0, len(lengths), LEAVES):
        own = lengths[k : k + LEAVES]
        leaves.append(Leaf(text[at : at + sum(own)], own, tokens[k : k + LEAVES]))
        at += leaves[-1].chars
    return leaves


class Tree:
    """A sequence of leaves under sums; leaves are numbered from 0."""

    def __init__(self, leaves: list[Leaf]):
        self.root = self._above(leaves or [Leaf("", [], [])])

    @staticmethod
    def _above(nodes: list):
        while len(nodes) > 1:
            nodes = [Inner(nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)]
        return nodes[0]

    def find(self, offset: int) -> tuple[int, int, int]:
        """(leaf, pre-token in it, its start) of the pre-token that holds the offset; the last one for the end."""
        node, number, start = self.root, 0, 0
        while isinstance(node, Inner):
            for child in node.children:
                if offset < start + child.chars or child is node.children[-1]:
                    break
                number, start = number + child.leaves, start + child.chars
            node = child
        for piece, length in enumerate(node.lengths):
            if offset < start + length or piece == node.pieces - 1:
                return number, piece, start
            start += length
        return number, 0, start

    def walk(self, number: int) -> Iterator[Leaf]:
        """The leaves from that number on."""
        stack = [(self.root, 0)]  # (node, number of its first leaf)
        while stack:
            node, first = stack.pop()
            if first + node.leaves <= number:
                continue
            if isinstance(node, Leaf):
                yield node
                continue
            at, below = first, []
            for child in node.children:
                if at + child.leaves > number:
                    below.append((child, at))
                at += child.leaves
            stack.extend(reversed(below))

    def replace(self, first: int, stop: int, fresh: list[Leaf]) -> None:
        """Puts new leaves in the place of those numbered from `first` up to, not including, `stop`."""
        self.root = self._above(self._spliced(self.root, first, stop, fresh) or [Leaf("", [], [])])
        while isinstance(self.root, Inner) and len(self.root.children) == 1:
            self.root = self.root.children[0]

    def _spliced(self, node, first: int, stop: int, fresh: list[Leaf]) -> list:
        """Nodes of the level of `node` for its leaves with [first, stop) replaced; fresh ones may need several."""
        if isinstance(node, Leaf):
            return fresh
        children, at, given = [], 0, False
        for child in node.children:
            low, high = first - at, stop - at
            at += child.leaves
            if high <= 0 or low >= child.leaves:
                children.append(child)
                continue
            children += self._spliced(child, max(0, low), min(high, child.leaves), [] if given else fresh)
            given = True
        if len(children) <= FAN:
            return [Inner(children)] if children else []
        number = -(-len(children) // FAN)
        edges = [len(children) * k // number for k in range(number + 1)]
        return [Inner(children[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


class CountedText:
    """A text in a tree of counted pre-tokens, and edits to it."""

    def __init__(self, text: str, counter: Counter, lengths: list[int] | None = None, tokens: list[int] | None = None):
        self.counter = counter
        if lengths is None:
            pieces = counter.pieces(text)
            lengths, tokens = list(map(len, pieces)), list(map(counter.__getitem__, pieces))
        self.tree = Tree(_cut_leaves(text, lengths, tokens))
        self.encoded = 0

    @property
    def tokens(self) -> int:
        return self.tree.root.total

    @property
    def text(self) -> str:
        return "".join(leaf.text for leaf in self.tree.walk(0))

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replaces code points [start, end)."""
        number, piece, place = self.tree.find(start)
        leaf = next(self.tree.walk(number))
        for _ in range(BACK):
            if not piece:
                if not number:
                    break
                number -= 1
                leaf = next(self.tree.walk(number))
                piece = leaf.pieces
            piece -= 1
            place -= leaf.lengths[piece]
        inside = sum(leaf.lengths[:piece])
        lengths, tokens, head = leaf.lengths[:piece], leaf.tokens[:piece], leaf.text[:inside]
        ahead, taken = self.tree.walk(number), []
        marks: list[tuple[int, int, int]] = []  # (old start, leaf taken, pre-token) of the pre-tokens at or after the edit's end
        built, cover = "", place - inside

        def more() -> bool:
            """Takes the next leaf in; False at the end of the text."""
            nonlocal built, cover
            leaf = next(ahead, None)
            if leaf is None:
                return False
            if cover + leaf.chars >= end:
                at = cover
                for k, length in enumerate(leaf.lengths):
                    if at >= end:
                        marks.append((at, len(taken), k))
                    at += length
            taken.append(leaf)
            built += leaf.text
            cover += leaf.chars
            return True

        while (not taken or cover < end) and more():
            pass
        built = built[inside:]
        built = built[: start - place] + replacement + built[end - place :]
        shift, fixed = len(replacement) - (end - start), start - place + len(replacement)
        at, mark, done = 0, 0, 0
        while True:
            while True:  # the first old boundary that is not behind
                while mark < len(marks) and marks[mark][0] + shift - place < at:
                    mark += 1
                if mark < len(marks) or not more():
                    break
            if at >= fixed and (mark < len(marks) and marks[mark][0] + shift - place == at or at == len(built)):
                break  # from here on both texts are cut alike
            found = self.counter.cut.match(built, at)
            while found.end() + 2 >= len(built) and more():
                found = self.counter.cut.match(built, at)
            lengths.append(found.end() - at)
            tokens.append(self.counter[found[0]])
            done += 1
            at = found.end()
        self.encoded += done
        rest, stop = "", number + len(taken)
        if mark < len(marks):
            _, where, k = marks[mark]
            last = taken[where]
            rest = last.text[sum(last.lengths[:k]) :]
            lengths, tokens = lengths + last.lengths[k:], tokens + last.tokens[k:]
            stop = number + where + 1
        self.tree.replace(number, stop, _cut_leaves(head + built[:at] + rest, lengths, tokens))


def edits_of(text: str) -> list[tuple[int, int, str]]:
    """The corpus's edit script for a text, last edit first so that offsets stay valid."""
    if "@" not in text:
        return []
    return [(m.start(), m.end(), MASK) for m in EMAIL.finditer(text)][::-1]


RESULT = "doc_id long, n_tokens long, n_pretokens long, n_edits long, n_tokens_edited long, n_reencoded long"


def _count(lines: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load_ranks(lines))
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                edits = edits_of(text)
                if not edits:
                    pieces = counter.pieces(text)
                    tokens = sum(map(counter.__getitem__, pieces))
                    rows.append((tokens, len(pieces), 0, tokens, 0))
                    continue
                counted = CountedText(text, counter)
                tokens, pieces = counted.tokens, counted.tree.root.pieces
                for edit in edits:
                    counted.edit(*edit)
                rows.append((tokens, pieces, len(edits), counted.tokens, counted.encoded))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            names = ["n_tokens", "n_pretokens", "n_edits", "n_tokens_edited", "n_reencoded"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", *names])

    return run


TREES = "doc_id long, text string, lengths binary, tokens binary, n_tokens long, n_edits long, n_reencoded long"


def _tree_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*rows, strict=True)) or [[]] * 7
    names = [c.split()[0] for c in TREES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _tree_row(doc_id: int | None, counted: CountedText, edits: int) -> tuple:
    leaves = list(counted.tree.walk(0))
    packed = [np.array([x for leaf in leaves for x in getattr(leaf, name)], np.int32).tobytes() for name in ("lengths", "tokens")]
    return doc_id, "".join(leaf.text for leaf in leaves), *packed, counted.tokens, edits, counted.encoded


def _build(lines: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load_ranks(lines))
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(start, ROWS_OUT)
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                yield _tree_batch([_tree_row(i, CountedText(t or "", counter), 0) for i, t in zip(ids, texts, strict=True)])

    return run


def _vocabulary_lines(vocabulary: str) -> list[bytes]:
    with open(vocabulary, "rb") as file:
        return file.read().splitlines()


def build_trees(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The tree of every row of `documents`: its text, the lengths and token counts of its pre-tokens as int32, and n_tokens.

    Null texts count as empty. Other columns are not looked at.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_build(_vocabulary_lines(vocabulary)), TREES)


def _edit(lines: list[bytes]):
    """Streams trees, each followed by its edits; holds one document at a time, however many edits it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load_ranks(lines))
        doc_id, counted, edits, out = None, None, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["seq"] is None:  # a tree
                    if counted is not None:
                        if row["doc_id"] is not None and row["doc_id"] == doc_id:
                            raise ValueError(f"two trees of document {doc_id}")
                        out.append(_tree_row(doc_id, counted, edits))
                    lengths, tokens = (np.frombuffer(row[c], np.int32).tolist() for c in ("lengths", "tokens"))
                    doc_id, counted, edits = row["doc_id"], CountedText(row["text"], counter, lengths, tokens), 0
                elif counted is not None and row["doc_id"] == doc_id:
                    size = counted.tree.root.chars
                    start = min(max(0, row["start"]), size)
                    counted.edit(start, min(max(start, row["stop"]), size), row["text"])
                    edits += 1
                if len(out) == 100:
                    yield _tree_batch(out)
                    out = []
        if counted is not None:
            out.append(_tree_row(doc_id, counted, edits))
        if out:
            yield _tree_batch(out)

    return run


def apply_edits(trees: DataFrame, edits: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """`trees` after `edits` (doc_id, seq, start, stop, replacement), with the number of edits and of pre-tokens that were encoded.

    A document's edits are applied in the order of seq (then start, stop, replacement), each to what the one
    before left; code points [start, stop) are replaced, ranges are cut to the text. Null numbers and
    replacements count as 0 and empty. Edits of unknown documents and null ids change nothing; two trees of one id
    that is edited are an error. Trees without edits stay as they are and where they are: only trees whose id a
    filter of fixed size cannot clear are shuffled (`idsets`).
    """
    blank = F.lit(None).cast("long")
    ids = checkpointed(edits.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id")).distinct())
    maybe, rest = suspects(trees, "doc_id", ids)
    untouched = rest.select("doc_id", "text", "lengths", "tokens", "n_tokens", *(F.lit(0).cast("long").alias(c) for c in ("n_edits", "n_reencoded")))
    first = maybe.select("doc_id", blank.alias("seq"), blank.alias("start"), blank.alias("stop"), "text", "lengths", "tokens")
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c)
    none = F.lit(None).cast("binary")
    text = F.coalesce(F.col("replacement").cast("string"), F.lit("")).alias("text")
    then = edits.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), zero("seq"), zero("start"), zero("stop"), text, none.alias("lengths"), none.alias("tokens"))
    bounded_batches(trees.sparkSession)
    dealt = first.unionByName(then).repartition("doc_id")  # null ids are never suspects
    order = (F.col("doc_id").asc_nulls_first(), F.col("seq").asc_nulls_first(), "start", "stop", "text")
    return untouched.unionByName(dealt.sortWithinPartitions(*order).mapInArrow(_edit(_vocabulary_lines(vocabulary)), TREES))


def token_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents after two edits of each: the source put before the text and the middle third cut out."""
    documents = table(spark, sf_dir, "documents")
    size = F.length(F.coalesce("text", F.lit("")))
    edit = lambda seq, start, stop, text: F.struct(F.lit(seq).alias("seq"), start.alias("start"), stop.alias("stop"), text.alias("replacement"))
    third = (size / 3).cast("int")
    both = F.array(edit(2, third, third * 2, F.lit("")), edit(1, F.lit(0), F.lit(0), F.concat(F.coalesce("source", F.lit("")), F.lit(": "))))
    edited = apply_edits(build_trees(documents), documents.select("doc_id", F.inline(both)))
    return edited.select("doc_id", "n_tokens", "n_edits", "n_reencoded")


def count_tokens(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token counts of every row of `documents`, before and after the edit script.

    Null and empty texts have 0 tokens. Repeated rows are counted each for itself; other columns
    are not looked at. The vocabulary file, of fixed size (under 1 MB), is read by the driver and
    sent with the map, so executors need no copy of it.
    """
    lines = _vocabulary_lines(vocabulary)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_count(lines), RESULT)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
