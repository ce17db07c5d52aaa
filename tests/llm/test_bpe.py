import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillcast.llm.bpe import Coder, Vocabulary, bpe_decode, bpe_digest, bpe_encode

PATH = public_tokenizers.path("word_bpe_49k.json")
REAL = Tokenizer.from_file(PATH)
REAL.no_truncation()
REAL.no_padding()
CODER = Coder(Vocabulary(PATH))

CASES = [
    None, "", " ", "\n\t", "hello world", "Hello, WORLD!! it's we've", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "a" * 3000,
    "abab" * 700, "Σίσυφος ΟΔΟΣ ΣΣ", "İstanbul ǅ ß ẞ", "é Å ﬁ", "x\x1cy\x1fz\x85w\xa0v u​t",
    "<|startoftext|>a<|endoftext|><|endoftext|> b<|endoftext", "日本語テキスト 12345 ٣٤", "👩‍👩‍👧 ok 🙂!!!???...",
    "don't 'S 'RE 'll'd", "\x00\x01 nul", "a\r\nb\x0b\x0cc", "né Él ÇA ñandú Straße", "x" * 50 + "!" * 999,
]


def real(text):
    got = REAL.encode(text or "", add_special_tokens=False).ids
    return got, REAL.decode(got, skip_special_tokens=False)


def check(texts):
    ids, starts = CODER.encode(texts)
    decoded = CODER.decode(ids, starts)
    for i, t in enumerate(texts):
        want, text = real(t)
        assert ids[starts[i]:starts[i + 1]].tolist() == want, repr(t)
        assert decoded[i] == text, repr(t)


def test_cases():
    check(CASES)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.text(alphabet="abehinort '!é́\nΣ<|>1", max_size=40),
    st.text(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=20)), max_size=6))
def test_any_text(texts):
    check(texts)


def test_frame(spark):
    rows = [(i, t, "x") for i, t in enumerate(CASES)] + [(None, "again again", None), (3, "again again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    enc = bpe_encode(df, PATH, decoded_col="decoded")
    assert enc.columns == ["doc_id", "text", "ids", "decoded"]
    got = sorted(map(tuple, bpe_digest(enc).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted([(i, len(real(t)[0]), sha(" ".join(map(str, real(t)[0]))), sha(real(t)[1])) for i, t, _ in rows], key=str)
    assert got == want
    again = bpe_decode(enc.drop("decoded"), PATH)
    assert sorted((r.doc_id or -1, r.decoded) for r in again.collect()) == sorted((i or -1, real(t)[1]) for i, t, _ in rows)
    assert bpe_encode(df.limit(0), PATH).count() == 0
