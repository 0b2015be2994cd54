"""Token counts of a unigram language model, by dynamic programming over a trie of pre-tokens.

Pre-tokens are the words between white space, each with a leading word mark. A trie holds the distinct
ones; each node has the best forward score of its prefix and the tokens on that best path, computed once however
many pre-tokens share the prefix. A terminal's count is the number of tokens of its pre-token.
"""

from __future__ import annotations

from collections import deque
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import col, map_rows, read

MARK = "▁"


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> dict[str, float]:
    """Log-probabilities by Zipf's law of the pieces' ranks in the file; control, unknown and byte pieces don't count."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    norm = log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: -log(r + 1) - norm for r, p in enumerate(pieces)}


class ForwardTrie:
    """At max_nodes nodes it starts anew, which costs time but changes no count.

    Beyond `deepest` characters a pre-token adds no nodes: its scores go on in a window as wide as the longest piece.
    """

    def __init__(self, scores: dict[str, float], max_nodes: int = 500_000, deepest: int = 4096):
        self.scores, self.max_nodes, self.deepest = scores, max_nodes, deepest
        self.longest = max(map(len, scores))
        self.suffixes = {p[i:] for p in scores for i in range(len(p))}
        self.unknown = min(scores.values()) - 10
        self.reset()

    def reset(self) -> None:
        self.child: dict[int, int] = {}  # node * 2^21 + code point -> node
        self.score, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of a pre-token; ties of score go to the fewer tokens. A character that no piece has costs its UTF-8 bytes."""
        known = self.terminal.get(word)
        if known is not None:
            return known
        if len(self.score) > self.max_nodes:
            self.reset()
        text, node, path = MARK + word, 0, [0]
        child, score, tokens, scores, suffixes = self.child, self.score, self.tokens, self.scores, self.suffixes
        for end in range(1, min(len(text), self.deepest) + 1):
            key = node << 21 | ord(text[end - 1])
            node = child.get(key, -1)
            if node < 0:
                last = path[-1]
                best, fewest = score[last] + self.unknown, tokens[last] + len(text[end - 1].encode("utf-8", "replace"))
                for start in range(end - 1, -1, -1):
                    part = text[start:end]
                    if part not in suffixes:
                        break
                    s = scores.get(part)
                    if s is not None:
                        s += score[path[start]]
                        n = tokens[path[start]] + 1
                        if s > best or s == best and n < fewest:
                            best, fewest = s, n
                node = child[key] = len(score)
                score.append(best)
                tokens.append(fewest)
            path.append(node)
        if len(text) > self.deepest:
            return self._beyond(text, deque(((score[x], tokens[x]) for x in path[-self.longest :]), maxlen=self.longest))
        self.terminal[word] = tokens[node]
        return tokens[node]

    def _beyond(self, text: str, window: deque) -> int:
        """window: (score, tokens) of the last prefixes of text[:deepest]; the same recurrence up to the end of text."""
        scores, suffixes = self.scores, self.suffixes
        for end in range(self.deepest + 1, len(text) + 1):
            last = window[-1]
            best, fewest = last[0] + self.unknown, last[1] + len(text[end - 1].encode("utf-8", "replace"))
            for back in range(1, len(window) + 1):
                part = text[end - back : end]
                if part not in suffixes:
                    break
                s = scores.get(part)
                if s is not None:
                    before = window[-back]
                    s += before[0]
                    n = before[1] + 1
                    if s > best or s == best and n < fewest:
                        best, fewest = s, n
            window.append((best, fewest))
        return window[-1][1]


def count_tokens(df: DataFrame, model_file: str, id_col: str, text_col: str, max_nodes: int = 500_000) -> DataFrame:
    """(doc_id, n_words, n_tokens) for each row; null, empty and blank texts have none. Ties are settled in ForwardTrie.count.

    Each task keeps one trie for all its rows, of bounded size, so nothing is shuffled. Repeated rows stay
    repeated; other columns are ignored. model_file must be there on every executor.
    """

    def rows(incoming):
        trie = ForwardTrie(vocabulary(model_file), max_nodes)
        for key, text in incoming:
            words = (text or "").split()
            yield key, len(words), sum(map(trie.count, words))

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])
    return map_rows(df.select(col(id_col).cast("long"), col(text_col).cast("string")), rows, schema, "doc_id long, n_words long, n_tokens long")


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), "doc_id", "text")
