import random

import numpy as np

from aloft.llm import langid
from aloft.llm.queries import QUERIES

from .conftest import prose

SAMPLES = {"aa": prose(1, 800), "bb": prose(2, 800, ("xor", "ypsi", "zut", "wal"))}


def test_phrases_equal_greedy_longest_matches():
    parser = langid.CrossParser(SAMPLES)
    for text in (prose(5, 30), prose(6, 30, ("xor", "zut", "alo")), "q", "a", "x y z 1 2!!"):
        codes = parser.codes(text)
        got = parser.phrases([codes])[:, 0]
        for k, lang in enumerate(parser.langs):
            sample = bytes(parser.codes(SAMPLES[lang]))
            at, n = 0, 0
            while at < len(codes):
                end = at + 1
                while end < len(codes) and bytes(codes[at:end + 1]) in sample and codes[end]:
                    end += 1
                at, n = end, n + 1
            assert got[k] == n


def _greedy(codes, sample):
    """Phrases by longest matches found with ``in``."""
    at, n = 0, 0
    while at < len(codes):
        end = at + 1
        while end < len(codes) and codes[at] in sample and codes[at:end + 1] in sample:
            end += 1
        at, n = end, n + 1
    return n


def test_pieces_do_not_cut_phrases(monkeypatch):
    """Texts that never fall into step with a parse from a piece's start are among them."""
    samples = {"aa": SAMPLES["aa"] + " " + "q" * 7 + " qz", "bb": SAMPLES["bb"] + " zzzzz"}
    texts = [prose(7, 400), prose(8, 300, ("xor", "ypsi")), "q" * 500, "z" * 501 + "q" * 99, "", "a", prose(9, 9) + "#" * 90]
    for size in (1, 3, 10, 64, 2048):
        monkeypatch.setattr(langid, "PIECE", size)
        parser = langid.CrossParser(samples)
        codes = [parser.codes(t) for t in texts]
        got = parser.phrases(codes)
        for k, lang in enumerate(parser.langs):
            sample = bytes(parser.codes(samples[lang]).tolist())
            assert got[k].tolist() == [_greedy(bytes(c.tolist()), sample) for c in codes]


def test_pieces_with_searched_letters(monkeypatch):
    monkeypatch.setattr(langid, "CLASSES", 3)
    text, want = prose(7, 400), None
    for size in (5000, 7, 31):
        monkeypatch.setattr(langid, "PIECE", size)
        parser = langid.CrossParser(SAMPLES)
        got = parser.phrases([parser.codes(text)]).tolist()
        want = want or got
        assert got == want


def test_a_language_of_very_long_rows_is_learned(spark):
    rows = [(1, prose(3, 60_000), "aa"), (2, prose(4, 60_000, ("xor", "ypsi", "zut")), "bb")]
    assert min(len(t) for _, t, _ in rows) > langid.SAMPLE
    made = langid.samples(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(made) == {"aa", "bb"} and all(10_000 < len(t) <= 2 * langid.SAMPLE for t in made.values())
    assert langid.CrossParser(made).predict([prose(5, 50), prose(6, 50, ("ypsi", "zut"))])[0] == ["aa", "bb"]


def test_long_text_is_parsed_in_pieces():
    parser = langid.CrossParser(SAMPLES)
    text = prose(7, 5000, ("xor", "ypsi"))
    assert len(text) > 3 * langid.PIECE
    assert parser.predict([text, prose(8, 3000)])[0] == ["bb", "aa"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op4_language_id"](spark, sf).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = langid.identify(odd_docs, SAMPLES).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    und = spark.createDataFrame([(1, None), (2, ""), (3, "12 ?! \n"), (4, "alo")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(und, SAMPLES).orderBy("doc_id").collect()] == [
        "und", "und", "und", "aa"]
    assert {r.lang_pred for r in langid.identify(odd_docs, {}).collect()} == {"und"}
    assert langid.samples(no_docs) == {} and langid.identify(no_docs, SAMPLES).count() == 0


def test_wrong_labels_are_left_out():
    rows = {k: [prose(s, 60, st) for s in range(20)] for k, st in
            (("aa", ("alo", "beri", "cado")), ("bb", ("xor", "ypsi", "zut")))}
    rows["aa"].append(prose(99, 60, ("xor", "ypsi", "zut")))
    assert len(langid.agreed(rows, 10_000)["aa"]) == 20


def test_every_letter_of_several_scripts():
    # one alphabet of syllables each; together far above CLASSES letters
    starts = {"el": 0x3B1, "ru": 0x430, "ar": 0x627, "ja": 0x3042, "zh": 0x4E00, "zz": 0x4E00 + 300}
    of = {k: "".join(chr(c) for c in range(at, at + 300) if chr(c).isalpha() and chr(c).islower() == (k in ("el", "ru")))
          for k, at in starts.items()}
    of["el"], of["ru"] = of["el"][:24], of["ru"][:32]

    def written(lang, seed, n):
        r = random.Random(seed)
        words = ["".join(random.Random(f"{lang}{i}").choices(of[lang], k=3)) for i in range(200)]
        return " ".join(r.choice(words) for _ in range(n))

    rows = {k: written(k, 1, 1500) for k in of}
    rows["aa"] = prose(1, 1500)  # the commonest letters are Latin
    parser = langid.CrossParser(rows)
    assert parser.predict([written(k, 2, 20) for k in of])[0] == list(of)
    assert not (parser.codes("".join(rows.values())) == 0).any()
    for k in of:
        text, sample = parser.codes(written(k, 3, 15)).tolist(), parser.codes(rows[k]).tolist()
        at, n = 0, 0
        while at < len(text):
            spots = [i for i in range(len(sample)) if sample[i] == text[at]]
            end = at + 1
            while end < len(text) and (spots := [i for i in spots if sample[i + end - at:i + end - at + 1] == [text[end]]]):
                end += 1
            at, n = end, n + 1
        assert parser.phrases([np.array(text, np.int32)])[parser.langs.index(k), 0] == n


def test_letters_whose_case_depends_on_the_place():
    parser = langid.CrossParser({"el": "ΟΔΟΣ", "tr": "İI"})
    assert (parser.codes("ΟΔΟΣ İ οδοσ") > 0).all()
