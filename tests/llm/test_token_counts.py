from hypothesis import given, settings
from hypothesis import strategies as st
import public_tokenizers
from tokenizers import Tokenizer, models

from quillgraph.llm.token_counts import MARK, ForwardTrie, count_tokens, vocabulary

from .helpers import docs, rows

FILE = public_tokenizers.path("piece_bpe_32k.model")


def reference():
    scores = vocabulary(FILE)
    return Tokenizer(models.Unigram([("<unk>", 0.0), *[(p, s) for p, s in scores.items() if p != "<unk>"]], unk_id=0, byte_fallback=False))


def test_counts_agree_with_the_tokenizers_unigram_model():
    t, trie = reference(), ForwardTrie(vocabulary(FILE))
    words = "the Internationalization of tokens isn't hard naïveté Übermut https://example.com/x?y=1 aaaaaaaaaaaaaaaaaaaa 12345,67 straße %%%".split()
    assert [trie.count(w) for w in words] == [len(t.encode(MARK + w).ids) for w in words]


def brute(word, scores):
    text, unknown = MARK + word, min(scores.values()) - 10
    best = [(0.0, 0)] + [None] * len(text)
    for j in range(1, len(text) + 1):
        ways = [(best[j - 1][0] + unknown, -(-best[j - 1][1] + len(text[j - 1].encode("utf-8", "replace"))))]
        ways += [(best[i][0] + scores[text[i:j]], best[i][1] - 1) for i in range(j) if text[i:j] in scores]
        best[j] = max(ways)
    return -best[-1][1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=("Cs", "Z", "Cc")), min_size=1, max_size=12), min_size=1, max_size=5))
def test_trie_agrees_with_viterbi_by_word(ws):
    scores = vocabulary(FILE)
    trie = shared
    assert [trie.count(w) for w in ws] == [brute(w, scores) for w in ws] == [shallow.count(w) for w in ws]


def test_long_pretokens_add_no_nodes_beyond_the_depth():
    deep, trie = ForwardTrie(vocabulary(FILE), deepest=1 << 30), ForwardTrie(vocabulary(FILE))
    word = "Internationalization0123456789abcé漢" * 3000
    assert trie.count(word) == deep.count(word)
    assert len(trie.score) <= 4097 and not trie.terminal


shallow = ForwardTrie(vocabulary(FILE), deepest=3)
shared = ForwardTrie(vocabulary(FILE), max_nodes=50)


def test_table(spark):
    texts = ["the cat", None, "", " \n ", "the cat", "x" * 100_000]
    got = sorted(rows(count_tokens(docs(spark, texts, extra=True), FILE, "doc_id", "text")))
    assert [r[1] for r in got] == [2, 0, 0, 0, 2, 1] and got[0][2] == got[4][2] == sum(brute(w, vocabulary(FILE)) for w in ("the", "cat")) and got[1][2] == 0
    assert rows(count_tokens(docs(spark, []), FILE, "doc_id", "text")) == []
