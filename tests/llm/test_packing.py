import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskflow.llm.packing import CAPACITY, END_ID, Packer, UnitEncoder, added_tokens, class_of, pack
from tests.llm.conftest import ODD_ROWS

RANKS = public.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def padding(lengths):
    return sum(CAPACITY - n for n in lengths if n & (n - 1))


def test_ids_equal_the_json_tokenizer(tokenizer):
    units = UnitEncoder(RANKS, public.PATTERN)
    for text in ["", " ", "a", "The cat's mat, 12 dogs!", "a  b   c \n\n d\t e\r\n f ", "naïve  café\xa0  x",
                 "<|endoftext|> is text", "tail \n", " \n lead", "日本 語\x1c \x1d x", "a\x85 b", "x" * 3000]:
        got = np.frombuffer(units.encode(text), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, text


UNITS = UnitEncoder(RANKS, public.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t\xa0\x1fab1.é'")), max_size=40))
def test_cutting_before_spaces_changes_no_id(text):
    units = UNITS
    assert units.encode(text) == units.ids(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 6000), max_size=60))
def test_packer_places_every_token_once(lengths):
    packer = Packer(3)
    texts = {k: np.arange(k * 10_000, k * 10_000 + n, dtype="<u4").tobytes() for k, n in enumerate(lengths)}
    pieces = [p for k, ids in texts.items() for p in packer.add(k, ids)] + list(packer.close())
    seen, bins = defaultdict(dict), defaultdict(list)
    for key, start, ids, total, sequence, offset in pieces:
        assert total == lengths[key] and start not in seen[key] and ids
        seen[key][start] = ids
        bins[sequence].append((offset, len(ids) // 4))
    assert {k: b"".join(v for _, v in sorted(p.items())) for k, p in seen.items()} == texts
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= CAPACITY
    assert padding(sum(n for _, n in p) for p in bins.values()) <= sum(lengths) / 128


def test_classes_hold_a_fixed_count():
    for length in range(1, CAPACITY):
        k, cut = class_of(length)
        assert 0 < cut <= length and CAPACITY - CAPACITY // 32 <= k * cut <= CAPACITY


def check(out, rows, tokenizer):
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        want[doc_id].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID])
    bins = defaultdict(list)
    pieces = defaultdict(int)
    for r in out:
        assert any(zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
                   and len(ids) == r["doc_tokens"] for ids in want[r["doc_id"]])
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]] += r["length"]
    assert pieces == {k: sum(map(len, v)) for k, v in want.items()}
    assert all(sum(n for _, n in p) <= CAPACITY for p in bins.values())


def test_odd_rows(odd_docs, clashing, tokenizer):
    for docs in (odd_docs, clashing):
        check(pack(docs, RANKS, public.PATTERN, with_ids=False).collect(), ODD_ROWS, tokenizer)


def test_operator_gives_the_ids(docs_of, tokenizer):
    row = pack(docs_of([(1, "some words")], 1), RANKS, public.PATTERN).orderBy("start").collect()
    assert [i for r in row for i in r["ids"]] == tokenizer.encode("some words").ids + [END_ID]


def test_empty_table(docs_of):
    assert pack(docs_of([]), RANKS, public.PATTERN).collect() == []


ADDED_TEXTS = ["one document<|endoftext|>another", "<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>  b c",
               "<|endoftext|><|endoftext|>\n x", "<|endoftext|", "<|ENDOFTEXT|> <|endoftext|>s", "it<|endoftext|>'s 1"]


def as_opened():
    """The tokenizer with the settings of its file."""
    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def test_added_tokens_are_matched_in_the_text():
    units = UnitEncoder(RANKS, public.PATTERN, added_tokens(public.path("byte_bpe_50k.json")))
    for text in [*ADDED_TEXTS, "no added token  in here"]:
        got = np.frombuffer(units.encode(text), "<u4").tolist()
        assert got == as_opened().encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("query", ["op3_packing", "pipeline"])
def test_queries_match_added_tokens(spark, docs_of, tmp_path, query):
    import corpus_pipeline
    from riskflow.llm import queries
    docs = docs_of(list(enumerate(ADDED_TEXTS)))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = (queries.op3_packing(spark, str(tmp_path)) if query == "op3_packing"
           else corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)))
    check(out.collect(), list(enumerate(ADDED_TEXTS)), as_opened())
