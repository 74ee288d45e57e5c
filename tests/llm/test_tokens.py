import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kindling.llm import tokens as K

PATH = public_tokenizers.path(K.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(df, library):
    rows = df.select("doc_id", "text").collect()
    want = sorted(zip([str(r.doc_id) for r in rows], [len((r.text or "").encode()) for r in rows], expected(library, [r.text for r in rows])))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in K.token_counts(df, PATH).collect()) == want


def test_edge_cases_match_the_library(edge, library):
    check(edge, library)


def test_driver_rows_match_the_library(small, library):
    check(small("documents"), library)


def test_special_strings_spaces_and_scripts(docs_of, library):
    rnd = random.Random(7)
    letters = list("abcde ABC  \n\t\r\x0b\x0c\x1c\x1d'sdrtvlméüß123½²ⅷ.,!?<|>") + ["\x85", "\xa0", " ", "　", "一", "中", "😀", "́", "<|endoftext|>"]
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 50))) for _ in range(3000)]
    texts += ["<|endoftext|>", "<|endoftext|><|endoftext|> x", "a" * 30_000, " " * 5_000, "ab" * 9_000, "ha" * 3 + "!" * 4000]
    check(docs_of([(k, t, None, None) for k, t in enumerate(texts)]), library)


def test_a_full_table_changes_nothing(small, library):
    docs = small("documents")
    got = {r.doc_id: r.n_tokens for r in K.token_counts(docs, PATH, remembered=3).collect()}
    assert got == {r.doc_id: r.n_tokens for r in K.token_counts(docs, PATH).collect()}


def test_merging_by_rank_leftmost_first():
    ranks = {(1, 2): (0, 4), (2, 3): (1, 5), (4, 3): (2, 6), (1, 1): (3, 7), (7, 7): (4, 8)}
    assert K.merged_length([1, 2, 3], ranks) == 1      # 12 then 123
    assert K.merged_length([2, 3], ranks) == 1
    assert K.merged_length([1] * 4, ranks) == 1
    assert K.merged_length([1] * 5, ranks) == 2
    assert K.merged_length([3, 3], ranks) == 2
    assert K.merged_length([], ranks) == 0


def test_empty(empty):
    assert K.token_counts(empty, PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        K.load_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
