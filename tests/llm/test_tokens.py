import public_tokenizers
import sentencepiece

from kinelake.llm import tokens
from kinelake.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def library(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return [len(model.encode(t or "", num_threads=1)) for t in texts]


def test_whole_table_against_the_library(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op6_token_counts"](spark, sf).collect()
    want = dict(zip(docs, library(docs.values())))
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.n_bytes == len(docs[r.doc_id].encode()) and r.over_limit == (want[r.doc_id] > 4096) for r in got)


def test_hard_texts(spark):
    texts = ["", None, " ", "  ", "a ", " a", "a  b   c", "a\n\n b\r\n\tc \n", "<s> </s> <unk> <0x0A>", "▁a▁ ▁▁b", "\n", "\n \n", "日本語 テキスト ǘ 😀", "x" * 5000, "ab" * 300 + " ", " a b", "a\x00b", "(); {\r\n}\r\n", "def f(x):\n\treturn  x\n"]
    df = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(df, MODEL, entries=3).collect()}
    assert got == dict(enumerate(library(texts)))
    twice = tokens.count_tokens(df.union(df), MODEL).collect()
    assert len(twice) == 2 * len(texts)
    assert tokens.count_tokens(df.limit(0), MODEL).count() == 0
