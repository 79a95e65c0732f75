import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vigie.llm import lexicon
from vigie.llm.common import tokenizer_path
from vigie.llm.merges import Merges
from vigie.llm.wordbpe import WordEncoder

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encode(encoder, texts):
    codes, ends, whole, _ = encoder.batch(texts)
    out, at = [], 0
    for i, end in enumerate(ends.tolist()):
        out.append(list(whole[i]) if i in whole else encoder.expand(codes[at:end]).tolist())
        at = end
    return out


def test_every_latin_pair_equals_the_library(library):
    text = "".join(chr(a) + chr(b) for a in range(256) for b in [*range(0, 256, 5), 39, 115, 116])
    assert encode(WordEncoder(PATH), [text]) == [library.encode(text, add_special_tokens=False).ids]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(), st.sampled_from("aetÉß's !<|>endoftext 09\u00a0\u0085İΣ")), max_size=60), max_size=5))
def test_any_text_equals_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    library = Tokenizer.from_file(PATH)
    assert encode(WordEncoder(PATH, limit=20), texts + texts) == [library.encode(t, add_special_tokens=False).ids for t in texts + texts]


def test_merges_of_a_plain_vocabulary():
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    words = [w.encode() for w in ("hello", "internationalization", "x", "ünïcödé", "aaaaaaaaaaaaaaaaa", "thononththe")]
    ids, lens = Merges(path).encode(words)
    assert ids.tolist() == [i for w in words for i in library.encode(w.decode(), add_special_tokens=False).ids]
    assert lens.sum() == len(ids)


def test_automaton_is_minimal_and_exact():
    rng = random.Random(3)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))) for _ in range(300)} | {b"walking", b"talking", b"walk", b"talk"})
    ids = [[i, i * 2] for i in range(len(words))]
    tables = lexicon.compile_lexicon(words, ids)
    mapped = lexicon.Lexicon.mapped(lexicon.pack(tables))
    assert mapped.find(words).tolist() == list(range(len(words)))
    assert [list(x) for x in mapped.lookup(words)] == ids
    other = [w + b"z" for w in words] + [w[:-1] for w in words if len(w) > 1 and w[:-1] not in set(words)] + [b"zzz"]
    assert set(mapped.find(other).tolist()) == {-1}
    # minimal: as many states as there are different right languages
    suffixes = {}
    for w in words:
        for k in range(len(w) + 1):
            suffixes.setdefault(w[:k], set()).add(w[k:])
    assert len({s // 257 for s in tables["key"].tolist()}) == len({frozenset(v) for v in suffixes.values()})


def test_empty_lexicon():
    mapped = lexicon.Lexicon.mapped(lexicon.pack(lexicon.compile_lexicon([], [])))
    assert mapped.lookup([b"a", b"bc"]) == [None, None]


@pytest.mark.parametrize("size", [1, 50, 1 << 16])
def test_round_trip(docs, rows, library, empty, size):
    got = lexicon.encode_decode(docs, PATH, columns=("doc_id", "text"), size=size, digests=True).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["_n_tokens"] == len(ids)
        assert r["_ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["_decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    if size == 50:
        for r in lexicon.encode_decode(docs, PATH, columns=("text",), size=size).collect():
            assert r["_ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
            assert r["_decoded"] == library.decode(r["_ids"], skip_special_tokens=False)
        assert lexicon.encode_decode(empty, PATH, columns=("doc_id",)).count() == 0
