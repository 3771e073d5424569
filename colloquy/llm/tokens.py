"""Token counts: greedy longest-match word pieces, counted by one linear scan.

The vocabulary is a trie whose nodes carry a failure link and the number of pieces popped on the way along it
(the longest-match segmentation of what the link leaves behind). A word is read character by character; when
the trie has no way on, the link's count is added and the scan goes on from the link's node. Every
character is read once and no piece is ever built.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import Shared, record_batches

MEMO_WORDS = 200_000  # words a worker remembers; it forgets them all when full, counts do not depend on it


class PieceCounter:
    """Counts of greedy longest-match pieces. ``start`` marks the first piece of a word, as in ``\\u2581the``.

    A word that the pieces cannot spell counts as one unknown token.
    """

    def __init__(self, pieces: list[str], start: str = "▁"):
        self.start = start
        self.next: list[dict[str, int]] = [{}, {}]  # 0: inside a word, 1: at its start
        whole = [False, False]
        for piece in pieces:
            first = piece.startswith(start)
            body = piece[len(start) :] if first else piece
            node = 1 if first else 0
            for c in body:
                step = self.next[node].get(c)
                if step is None:
                    step = len(self.next)
                    self.next.append({})
                    whole.append(False)
                    self.next[node][c] = step
                node = step
            if body:
                whole[node] = True
        n = len(self.next)
        self.link, self.popped = [-1] * n, [0] * n
        level = [(root, c, child) for root in (0, 1) for c, child in self.next[root].items()]
        while level:  # by depth, so that links of shorter strings are known
            deeper = []
            for parent, c, node in level:
                if whole[node]:
                    self.link[node], self.popped[node] = 0, 1
                else:
                    z, count = self.link[parent], self.popped[parent]
                    while z >= 0 and c not in self.next[z]:
                        count += self.popped[z]
                        z = self.link[z]
                    if z >= 0:
                        self.link[node], self.popped[node] = self.next[z][c], count
                deeper += [(node, c2, child) for c2, child in self.next[node].items()]
            level = deeper

    def count(self, word: str) -> int:
        """Pieces of one word; 0 if the pieces cannot spell it."""
        nxt, link, popped = self.next, self.link, self.popped
        node, total = 1, 0
        for c in word:
            step = nxt[node].get(c)
            while step is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 0
                step = nxt[node].get(c)
            node = step
        while node > 1:  # what is left must end in whole pieces
            total += popped[node]
            node = link[node]
        return total if node == 0 else 0


def load_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece model, without control and byte pieces."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]


def token_counts(docs: DataFrame, pieces: list[str], start: str = "▁") -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) per row of ``docs``; words are separated by white space.

    Null and empty texts have no words. Repeated rows count alike; extra columns are ignored. The automaton is
    built once and broadcast: its size is the vocabulary's, not the corpus's.
    """
    shared = Shared(docs.sparkSession, PieceCounter(pieces, start))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("n_unknown", pa.int64())])

    def run(batches):
        counter, memo = shared.value, {}

        def length(word: bytes) -> int:
            n = memo.get(word)
            if n is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                n = memo[word] = counter.count(word.decode("utf-8", "replace"))
            return n

        def rows():
            for b in batches:
                for doc, text in zip(b.column(0), b.column(1), strict=True):
                    words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                    found = [length(w) for w in words]
                    unknown = found.count(0)
                    yield doc.as_py(), len(words), sum(found) + unknown, unknown

        yield from record_batches(rows(), schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
