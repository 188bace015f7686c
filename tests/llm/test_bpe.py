import hashlib
import random

import numpy as np
import pytest
from conftest import rows
from texts import EDGES, edges, empty, frame
from tokenizers import Tokenizer

from cartlake.llm.bpe import codec, cuts, encode_documents, encode_long, join, read_spec
from cartlake.llm.queries import TOKENIZERS, VOCABULARY

PATH = f"{TOKENIZERS}/{VOCABULARY}"


@pytest.fixture(scope="module")
def spec():
    return read_spec(PATH)


@pytest.fixture(scope="module")
def known():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


KINDS = {
    "letters": "abcdefgh",
    "one letter": "a",
    "words": "the and of in to  \n",
    "digits": "0123456789",
    "mixed": "ab1!? '",
    "quotes": "'strevmd ",
    "blanks": " \n\t\r",
    "other blanks": "a  \x1c\x85 ",
    "accents": "éüñçß",
    "wide": "漢字かな🎉👩‍👧",
    "marks": "!?.,;:-_=+",
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("limit", [7, 40, 300])
def test_pieces_join_to_the_whole(spec, known, kind, limit):
    rnd = random.Random(limit)
    code = codec(spec)
    for size in (1, 20, 150, 2500):
        text = "".join(rnd.choice(KINDS[kind]) for _ in range(size))
        assert encode_long(text, code, limit).tolist() == known(text), text
        assert code.decode(known(text)) == text


def test_special_tokens(spec, known):
    code = codec(spec)
    end = "<|endoftext|>"
    for text in (end, f"a{end} b", "x" * 30 + end * 5 + "y" * 30, end[:-1], f" {end}\n"):
        assert code.encode(text) == known(text)
        for limit in (5, 14, 20):
            assert encode_long(text, code, limit).tolist() == known(text)


def test_code_points_of_all_kinds(spec, known):
    """The engine and the reference library class characters alike."""
    code = codec(spec)
    for start in range(0, 0x20000, 509):
        c = chr(start if not 0xD800 <= start < 0xE000 else 0x41)
        text = f"a{c}a1{c}1!{c}! {c}  {c}{c} b"
        assert code.encode(text) == known(text)


def test_cuts_cover_the_text():
    text = "ab " * 50 + "x" * 200 + " end"
    places = cuts(text, 20)
    at = [0, *(p for p, _ in places), len(text)]
    assert at == sorted(set(at)) and max(b - a for a, b in zip(at, at[1:])) <= 23
    assert all(text[p - 1] != " " and text[p] == " " for p, safe in places if safe)
    assert cuts("", 5) == [] and cuts("abc", 5) == []


def test_join_grows_its_window(spec, known):
    """A run of one letter has no token in common until the window is the whole."""
    code = codec(spec)
    for a, b in ((701, 333), (64, 1), (1, 64)):
        parts = (np.array(code.encode("a" * n)) for n in (a, b))
        assert join(*parts, code).tolist() == known("a" * (a + b))


def test_documents(spark, spec, known):
    rnd = random.Random(4)
    long = "".join(rnd.choice("abcdefghijklmnop") for _ in range(5000))
    data = [(r[0], r[1], r[3]) for r in EDGES] + [(100, long, "a"), (101, long, "a"), (100, long + " x", "a")]
    found = encode_documents(frame(spark, data), spec, piece=400)
    want = []
    for i, text, _ in data:
        ids = known(text or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), text or ""))
    got = [(r.id, r.n_tokens, bytes(r.ids), r.decoded) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    short = encode_documents(edges(spark), spec, summary=True)
    digest = [
        (i, n, hashlib.sha256(a).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, n, a, t in want[: len(EDGES)]
    ]
    assert rows(short, "id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(digest, key=repr)
    assert encode_documents(empty(spark), spec).count() == 0
