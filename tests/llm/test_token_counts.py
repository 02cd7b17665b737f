from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from lakemart.llm.token_counts import MARK, Automaton, count_tokens, default_vocabulary


def greedy(word, vocabulary, longest):
    n, at = 0, 0
    while at < len(word):
        for end in range(min(len(word), at + longest), at, -1):
            if word[at:end] in vocabulary:
                break
        else:
            return -1
        n, at = n + 1, end
    return n


@settings(max_examples=500, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.lists(st.text("abc", max_size=14), max_size=8))
def test_counts_equal_greedy_longest_match(vocabulary, words):
    automaton = Automaton(sorted(vocabulary))
    for word in words:
        assert automaton.count(word) == greedy(word, vocabulary, 5)


def test_whole_table_and_odd_rows(spark):
    model = SentencePieceProcessor(model_file=default_vocabulary())
    usual = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    longest = max(map(len, usual))
    odd = [(None, "x y"), (-1, None), (-2, ""), (-3, " \n\t "), (-4, "\U0001f9ff \U0001f9ff a"), (-5, "long" * 50_000), (-6, "a b a"), (-6, "a b a")]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = []
    for doc_id, text in texts:
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
        counts = [greedy(MARK + w, usual, longest) for w in words]
        want.append((doc_id, len(words), sum(1 if c < 0 else c for c in counts), sum(c < 0 for c in counts)))
    got = [tuple(r) for r in count_tokens(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string, n_words int")).count() == 0
