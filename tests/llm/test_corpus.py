import os
import random

import pytest

from gavelspark.llm import leakage as K
from gavelspark.llm import quality as Q
from gavelspark.llm import rules
from gavelspark.llm import tokenizer as T

VOCABULARY = f"{T.VOCABULARIES}/byte_bpe_50k.tiktoken"
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary")


def slow_bpe(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks.get(a + b, 10**9), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
        if best[0] == 10**9:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[p] for p in parts]


def test_rank_queue_finds_the_lowest():
    queue, rng, waiting = T.RankQueue(), random.Random(2), []
    for _ in range(3000):
        if waiting and rng.random() < 0.5:
            rank = queue.lowest()
            assert rank == min(waiting)[0]
            assert (rank, queue.pop(rank)) == min(waiting)
            waiting.remove(min(waiting))
        else:
            entry = (rng.randint(0, 50256), rng.randint(0, 99))
            waiting.append(entry)
            queue.push(*entry)
    assert T.RankQueue().lowest() == -1


@needs_vocabulary
def test_merges_equal_brute_force():
    ranks, rng = T.load_ranks(VOCABULARY), random.Random(3)
    for _ in range(400):
        piece = "".join(rng.choice("aabcdeé the ing0123éü漢") for _ in range(rng.randint(0, 40))).encode()
        assert T.merge_all(piece, ranks) == (slow_bpe(piece, ranks) if piece else [])


@needs_vocabulary
def test_corpus_equals_public_encoder(spark):
    import tiktoken

    texts = [None, "", " ", "a\r\n\tb  c", "<|endoftext|> it's x'LL", "é́​👩‍⚖️ 漢字", "z" * 20000, "no\x1cse\x85p", "12345 6,7"]
    public = tiktoken.Encoding("own", pat_str=r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""", mergeable_ranks=T.load_ranks(VOCABULARY), special_tokens={})
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, ids int")
    got = {r.doc_id: r.ids for r in T.encode_corpus(df, "doc_id", "text").collect()}
    for i, text in enumerate(texts):
        assert got[i] == (public.encode_ordinary(text) if text else [])
        assert public.decode(got[i]) == (text or "")  # exact round trip
    assert T.encode_corpus(df.limit(0), "doc_id", "text").count() == 0


@needs_vocabulary
def test_batches_with_many_tokens_are_cut(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(T, "MOST_TOKENS", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["one two three four", None, "a", "", "b c d", "e"])], names=["k", "text"])
    cut = list(T.encode_batches([batch, batch.slice(0, 0)], VOCABULARY))
    assert [b.column(0).to_pylist() for b in cut] == [[0], [1, 2, 3, 4], [5]]
    assert [len(x) for b in cut for x in b.column(1).to_pylist()] == [4, 0, 1, 0, 3, 1]


PASSAGE = "No lenient viaduct copied no stern steward over 22 objections while one weary narrator audited old Drini Crossing"


def test_leaks(spark):
    w = PASSAGE.split()
    texts = {
        1: "Before. " + PASSAGE + " After.",
        2: "x <b>" + "</b> ".join(w[2:10]).upper() + " y",
        3: " ".join(w[2:9]) + " but not the eighth",
        4: " ".join("​".join(x) for x in w[4:12]).replace("e", "é"),
        5: "\r\n> ".join(w[:8]),
        6: None,
        7: "",
        8: ("filler " * 30000) + PASSAGE,
        9: " ".join(reversed(w)),
    }
    docs = spark.createDataFrame([*texts.items(), (1, texts[1])], "doc_id bigint, text string")
    items = spark.createDataFrame([(70, PASSAGE), (71, "too short a passage"), (72, None), (70, PASSAGE), (73, "Some other text about the old Drini Crossing and the weary narrator of nothing")], "item_id bigint, passage string")
    assert {(r.doc_id, r.item_id) for r in K.find_leaks(docs, items).collect()} == {(i, 70) for i in (1, 2, 4, 5, 8)}
    assert K.find_leaks(docs, items).count() == 5
    assert K.find_leaks(docs.limit(0), items).count() == 0 and K.find_leaks(docs, items.limit(0)).count() == 0


def test_leaks_equal_brute_force():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    passages = [(i, [rng.choice(vocabulary) for _ in range(rng.randint(5, 40))]) for i in range(60)]
    index = K.ItemIndex(passages)
    shingles = {i: {tuple(w[k : k + 8]) for k in range(len(w) - 7)} for i, w in passages}
    for _ in range(150):
        text = [rng.choice([*vocabulary, "unknown"]) for _ in range(60)]
        if rng.random() < 0.8:
            source = rng.choice(passages)[1]
            at = rng.randint(0, max(0, len(source) - 8))
            text[20:20] = source[at : at + rng.randint(6, 14)]
        own = {tuple(text[k : k + 8]) for k in range(len(text) - 7)}
        assert set(index.leaks(text)) == {i for i, s in shingles.items() if s & own}


def test_shards_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, PASSAGE)], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, PASSAGE + f" {i}") for i in range(9)], "item_id bigint, passage string")
    monkeypatch.setattr(K, "SHARD", 2)
    assert K.find_leaks(docs, items).count() == 9


def test_shards_equal_one_index(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 60))] for _ in range(120)]
    items = spark.createDataFrame([(i, " ".join(p), "w1 w2", "w3") for i, p in enumerate(passages)], "item_id bigint, passage string, question string, answer string")
    texts = []
    for d in range(80):
        text = [rng.choice(vocabulary) for _ in range(200)]
        for p in rng.sample(passages, 2):
            at = rng.randint(0, len(p) - 8)
            text[50:50] = p[at : at + rng.randint(6, 20)]
        texts.append((d, " ".join(text)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    whole = {tuple(r) for r in K.leak_report(docs, items).collect()}
    monkeypatch.setattr(K, "SHARD", 25)
    assert {tuple(r) for r in K.leak_report(docs, items).collect()} == whole and len(whole) > 80


def test_long_markup_between_words_does_not_matter(spark):
    w = PASSAGE.split()
    text = " ".join(w[:5]) + " <a href='" + "x" * 5000 + "'> " + " ".join(w[5:9]) + " <" * 300
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    items = spark.createDataFrame([(70, PASSAGE)], "item_id bigint, passage string")
    assert K.find_leaks(docs, items).count() == 1


PROSE = "The committee on rules met after the recess and agreed that the bill would be read again. "
TABLE = "| 85,120 | Yaranquist | NP | 1971 |\n"


def test_quality(spark):
    texts = {1: PROSE * 3, 2: TABLE * 9, 3: PROSE * 5 + "\n" + TABLE * 3, 4: PROSE + "\n" + TABLE * 20, 5: (PROSE * 3).upper(), 6: None, 7: "", 8: " \n\t ", 9: "La comisión aprobó el texto de la enmienda por los votos de las cámaras.", 10: "x" * 50000, 11: "Everyone agreed on that."}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id bigint, text string, visible int")
    got = {r.doc_id: r for r in Q.rated_documents(df).collect()}
    assert {i for i, r in got.items() if r.rule} == {2, 4, 10}
    assert [got[i].rule for i in (6, 7, 8)] == [None] * 3 and got[8].visible == 0
    assert got[9].rule == 0 and got[1].n_words == len((PROSE * 3).split())
    assert Q.rated_documents(df, wanted=[]).filter("rule > 0").count() == 3
    assert Q.text_statistics(df.limit(0)).count() == 0


def test_garbled_text_is_no_prose_whatever_function_words_it_holds(spark):
    texts = {1: "O1|| th~~v# of the|;¦;�ad¦0~ and h�cke^ |;§0er#or to c~s;|1t§e 'al'#9|6¦and op^n#d the ~one; |` is in#d``ster`", 2: "O1|| th~~v# of the|;;~ad|0~ and h#cke^ |;#0er#or to c~s;|1t#e 'al'#9|6|and op^n#d the ~one; |` is in#d``ster`", 3: "the 85120 of 1971 and 44871 in 23907 to 66312 by 90554", 4: PROSE, 5: "«La comisión» aprobó el texto de la enmienda — por los votos de las cámaras."}
    got = {r.doc_id: r for r in Q.rated_documents(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert {i for i, r in got.items() if r.rule} == {1, 2, 3}
    assert got[2].symbol_ratio == sum(not (x.isalnum() or x == " ") for x in texts[2]) / len(texts[2].replace(" ", ""))
    assert got[3].digit_ratio == sum(x.isdigit() for x in texts[3]) / len(texts[3].replace(" ", ""))


def test_rule_induction_on_held_out_data():
    import numpy as np

    rng = np.random.default_rng(6)
    x = rng.random((3000, 4))
    y = ((x[:, 0] < 0.4) & (x[:, 2] > 0.5)) | (x[:, 1] > 0.9)
    names = list("abcd")
    learned = rules.induce(x[:2000], y[:2000], names)
    assert (rules.predict(learned, x[2000:], names) == y[2000:]).mean() > 0.97
    assert rules.to_case(learned).startswith("case when ") and rules.to_case([]) == "0"


def test_report_rates_question_and_answer(spark):
    docs = spark.createDataFrame([(1, PASSAGE + " What changed? The answer is Nevormere."), (2, PASSAGE)], "doc_id bigint, text string")
    items = spark.createDataFrame([(70, PASSAGE, "What changed?", "Nevormere", "x"), (71, PASSAGE, None, "", "x")], "item_id bigint, passage string, question string, answer string, text string")
    got = {(r.doc_id, r.item_id): (r.kind, r.question_overlap, r.answer_overlap) for r in K.leak_report(docs, items).collect()}
    assert got[1, 70] == ("whole", 1.0, 1.0) and got[2, 70] == ("passage_only", 0.0, 0.0)
    assert got[1, 71] == ("passage_only", None, None)
