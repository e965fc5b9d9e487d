"""Operators on texts: brute-force versions, and the cases that every one defines."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import langid, leaks, lm, mixing, near_text, pii, tokens
from tickloom.llm.queries import fold

WORD = "[^\x20\x09-\x0d]+"
ODD = [None, "", " \n\t ", "a", "Two words", "x " * 3000, "é" * 5000, "1" * 5000, "same text in two rows " * 4]


def lowered(text: str | None) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def table(spark, rows: list[tuple[int | None, str | None]], **extra):
    """Documents; ``extra`` columns bear names that operators use inside."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame


@pytest.fixture(scope="module")
def odd(spark):
    rows = [*enumerate(ODD), (3, "a"), (8, ODD[8]), (20, ODD[8]), (None, "a text without any id at all"), (None, None)]
    return table(spark, rows, n=1, word="w", state=2, source="s", lang="en", band=1, size=7, row_id=5)


def prose(seed: int, n: int) -> list[str]:
    source = random.Random(seed)
    return ["".join(source.choice("bcdfg") + source.choice("aeiou") for _ in range(source.randint(1, 4))) for _ in range(n)]


def groups_by_force(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets, root = {}, {}
    for doc, text in rows:
        w = lowered(text)
        sets[doc] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        root[doc] = doc

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}


def test_near_duplicates_match_brute_force(spark):
    source = random.Random(1)
    rows = []
    for family in range(12):
        words = prose(family, source.choice([4, 30, 120, 400]))
        for _ in range(source.choice([1, 3, 25])):
            changed = list(words)
            for _ in range(source.choice([0, 0, 1, 2, 8])):
                changed[source.randrange(len(changed))] = "zz" + str(source.randrange(99))
            rows.append((len(rows), " ".join(changed)))
    source.shuffle(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_text.near_duplicates(spark, table(spark, rows)).collect()}
    assert got == groups_by_force(rows)


def test_a_chain_of_links_is_one_group_and_blocks_are_exact(spark, monkeypatch):
    monkeypatch.setattr(near_text, "BLOCK_MEMBERS", 8)
    words = prose(5, 300)
    rows = [(100 - k, " ".join(words[4 * k : 4 * k + 200])) for k in range(24)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_text.near_duplicates(spark, table(spark, rows)).collect()}
    assert got == groups_by_force(rows)
    assert {c for _, c in got.values()} == {77}


def test_near_duplicates_of_odd_rows(spark, odd):
    rows = near_text.near_duplicates(spark, odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_shingles"] == by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == 0
    assert by_id[0]["component_id"] == 0 and by_id[1]["kept"]
    assert by_id[20]["component_id"] == 8 and not by_id[20]["kept"]
    assert sum(r["doc_id"] == 8 and r["kept"] for r in rows) == 2
    assert all(r["component_id"] is None and not r["kept"] for r in rows if r["doc_id"] is None)
    assert near_text.near_duplicates(spark, odd.limit(0)).count() == 0


def test_mixing_fills_budgets_exactly(spark, odd):
    rows = [(i, " ".join(prose(i, 1 + i % 50))) for i in range(400)]
    docs = table(spark, rows).withColumn("source", F.expr("case when doc_id < 130 then 'a' when doc_id % 5 = 0 then null else 'b' || doc_id % 3 end"))
    got = mixing.mix_sources(spark, docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert (got["taken"] <= 2 * got["size"]).all()
    per = got.groupby("source", dropna=False).agg({"size": "sum", "taken": "sum", "target": "first", "source_size": "first"})
    assert (per["size"] == per["source_size"]).all()
    assert (per["taken"] == per["target"].apply(math.floor)).all()
    assert math.isclose(per["target"].sum(), 1.5 * per["size"].sum())
    again = mixing.mix_sources(spark, docs.repartition(3)).select("doc_id", "taken").toPandas()
    assert dict(again.values) == dict(got[["doc_id", "taken"]].values)
    assert mixing.mix_sources(spark, odd).count() == odd.count()
    assert mixing.mix_sources(spark, odd.limit(0)).count() == 0
    blank = mixing.mix_sources(spark, odd.where("doc_id < 3")).collect()
    assert [(r["taken"], r["target"]) for r in blank] == [(0, 0.0)] * 3


def test_tokens_match_the_library(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    letters = "aAbB'sSdDtTéÉ1½²٣_-<|>Σσς́İß  \x1c\x85.,!你好ﬁ①\x00"
    source = random.Random(2)
    texts = ["".join(source.choice(letters) for _ in range(source.randint(0, 80))) for _ in range(400)]
    texts += ["<|startoftext|>a<|endoftext|> <|ENDOFTEXT|>", "don't we'll I'M", "a" * 3000, *(t or "" for t in ODD)]
    got = tokens.token_counts(spark, table(spark, list(enumerate(texts))), path).toPandas().sort_values("doc_id")
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert list(got["n_tokens"]) == want
    assert list(got["n_bytes"]) == [len(t.encode()) for t in texts]
    assert list(got["over_limit"]) == [n > 2048 for n in want]
    none = tokens.token_counts(spark, odd.where("text is null"), path).collect()
    assert all((r["n_bytes"], r["n_tokens"], r["over_limit"]) == (0, 0, False) for r in none)
    assert tokens.token_counts(spark, odd, path).count() == odd.count()
    assert tokens.token_counts(spark, odd.limit(0), path).count() == 0


def test_scores_learn_all_words_and_are_probabilities(spark, odd):
    rows = [(i, " ".join(prose(i % 40, 60) + ["the"] * 9).title()) for i in range(120)]
    docs = table(spark, rows).withColumn("held_out", fold("doc_id", 7) == 2)
    held = {r["doc_id"]: r["held_out"] for r in docs.collect()}
    counts = Counter(w for i, t in rows if not held[i] for w in [*lowered(t), "\n"])
    total, distinct = sum(counts.values()), len(counts)
    for r in lm.score_texts(spark, docs).collect():
        w = [*lowered(rows[r["doc_id"]][1]), "\n"]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), total)
        assert math.isclose(r["base_score"], sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w))
        assert r["score"] < 0
    again = {r["doc_id"]: r["score"] for r in lm.score_texts(spark, docs.repartition(5)).collect()}
    assert all(math.isclose(again[r["doc_id"]], r["score"], rel_tol=1e-4) for r in lm.score_texts(spark, docs).collect())
    strange = lm.score_texts(spark, odd.withColumn("held_out", F.lit(None).cast("boolean")))
    assert strange.count() == odd.count()
    empty = strange.where("doc_id = 0").first()
    assert (empty["n_tokens"], empty["n_bytes"], empty["bits_per_byte"]) == (1, 0, None)
    untaught = lm.score_texts(spark, odd.withColumn("held_out", F.lit(True))).where("doc_id = 3").first()
    assert untaught["train_tokens"] == 0 and untaught["base_score"] == 0 and untaught["score"] < 0
    assert lm.score_texts(spark, odd.limit(0).withColumn("held_out", F.lit(False))).count() == 0


def test_bits_of_all_next_words_do_not_exceed_one(spark):
    """The code of single letters under one state, ends included, is a proper code."""
    import numpy as np

    from tickloom.llm.ragged import flat
    import pyarrow as pa

    counts = [np.zeros((1 << size, 2), np.float32) for size in lm.SLOT_BITS]
    marks = lm.marked(["the", "a"], [(1, "the")])
    mixer = lm.Mixer(counts, marks)
    mixer.freeze(counts)
    words = [chr(c) for c in range(33, 127)]
    bits = mixer.bits(*lm._spelled(*flat(pa.array(words))), np.ones(len(words), np.int64))
    assert np.exp2(-bits).sum() <= 1


def paraphrased(words: list[str], every: int) -> str:
    return " ".join(w for k, w in enumerate(words) if (k + 1) % every or k >= len(words) - 5)


def test_contexts_of_one_to_six_bytes_and_sixteen_states():
    def at_last(word: str, state: int) -> list[tuple]:
        spelled = lm._spelled(*lm.flat(pa.array([word])))
        return [tuple(found[-2]) for found in lm.slots(*spelled, np.array([state]))[0]]

    word = "abcdefghq"
    for shared, alike in ((1, {0}), (2, {0, 1}), (3, {0, 1, 2}), (4, {0, 1, 2, 3}), (6, {0, 1, 2, 3, 4})):
        other = "z" * (8 - shared) + word[8 - shared :]
        same = {i for i, (a, b) in enumerate(zip(at_last(word, 1), at_last(other, 1))) if a == b}
        assert same == alike, shared
    assert len({at_last(word, state)[lm.STATE_WORD] for state in range(lm.STATES)}) == lm.STATES == 16


def test_mixing_weights_are_learned_from_all_pairs(spark, monkeypatch):
    seen, learn = [], lm.Mixer.learn
    monkeypatch.setattr(lm, "MIXER_PAIRS", 1, raising=False)  # of a sample, were there one
    monkeypatch.setattr(lm.Mixer, "learn", lambda mixer, *a: seen.append((learn(mixer, *a), mixer.weights)))
    rows = [(i, " ".join(prose(i % 40, 60) + ["the"] * 9)) for i in range(120)]
    docs = table(spark, rows).withColumn("held_out", F.lit(False))
    lm.score_texts(spark, docs).count()
    (bits, weights), = seen
    assert math.isclose(bits, sum(8 * (len(w) + 1) for _, t in rows for w in [*lowered(t), "\n"]), rel_tol=1e-6)
    assert np.isfinite(weights).all() and np.abs(weights - 1 / lm.N_PREDICTORS).max() > 0.05


def test_leaks_copies_paraphrases_and_clean_texts(spark, odd):
    items = [(i, " ".join(prose(1000 + i, 20 + i))) for i in range(30)] + [(30, "too short"), (31, None), (None, "no id here at all you see")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("x"))
    noise = lambda k: " ".join(prose(5000 + k, 60))
    rows = [(k, noise(k)) for k in range(60)]
    rows += [(100 + i, f"{noise(i)} {items[i][1].upper()}! {noise(99 + i)}") for i in range(30)]
    rows += [(200 + i, f"{noise(i)} {paraphrased(items[i][1].split(), 4)} {noise(50 + i)}") for i in range(30)]
    rows += [(300 + i, f"{noise(i)} {' '.join(items[i][1].split()[: 8])} {noise(20 + i)}") for i in range(30)]
    found = {r["doc_id"]: r for r in leaks.find_leaks(spark, table(spark, rows, item_id=4, overlap=1), benchmark).collect()}
    assert all(found[100 + i]["item_ids"] == [i] and found[100 + i]["overlap"] == 1 for i in range(30))
    assert all(found[200 + i]["item_ids"] == [i] and 0.6 <= found[200 + i]["overlap"] for i in range(30))
    assert not any(r["contaminated"] for d, r in found.items() if d < 100 or d >= 300)
    assert leaks.find_leaks(spark, odd, benchmark).where("contaminated").count() == 0
    assert leaks.find_leaks(spark, odd, benchmark).count() == odd.count()
    assert leaks.find_leaks(spark, odd, benchmark.limit(0)).count() == odd.count()
    assert leaks.find_leaks(spark, odd.limit(0), benchmark).count() == 0


def test_short_items_word_for_word_are_found_at_every_offset(spark):
    """Among rarer words of other items, which keep the cosine of the window low."""
    items = [(n, " ".join(prose(3000 + n, n))) for n in range(5, 16)] + [(99, " ".join(prose(3999, 600)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rare = prose(3999, 600)
    rows = []
    for n, text in items[:-1]:
        for offset in range(8):
            source = random.Random(offset)
            around = lambda k: " ".join(source.choice(rare) for _ in range(k))
            rows.append((1000 * n + offset, f"{around(16 + offset)} {text.title()}, {around(20)}"))
    # The words of the items are frequent, and so weigh less than those around.
    rows += [(100_000 + k, " ".join(random.Random(k).sample(" ".join(t for _, t in items[:-1]).split(), 60))) for k in range(300)]
    found = {r["doc_id"]: r for r in leaks.find_leaks(spark, table(spark, rows), benchmark).collect()}
    missed = [d for d, _ in rows if d < 100_000 and (d // 1000 not in found[d]["item_ids"] or found[d]["overlap"] < 1)]
    assert not missed


@pytest.mark.parametrize("n_clean", [200, 2000])
def test_items_of_frequent_words_are_found_in_small_and_large_tables(spark, n_clean):
    """Copies of one item make its words frequent; another has words that all texts hold."""
    hot, common = prose(8001, 40), prose(8002, 12)
    benchmark = spark.createDataFrame([(1, " ".join(hot)), (2, " ".join(common))], "item_id long, text string")
    rows = [(k, " ".join(random.Random(k).sample(common, 5) + prose(9000 + k, 35))) for k in range(n_clean)]
    rows += [(10_000 + k, " ".join(hot)) for k in range(n_clean // 2)]
    rows += [(20_000, " ".join(prose(1, 30) + common + prose(2, 30))), (20_001, " ".join(prose(3, 9)) + " " + paraphrased(hot, 4))]
    found = {r["doc_id"]: r["item_ids"] for r in leaks.find_leaks(spark, table(spark, rows), benchmark).collect()}
    assert all(found[d] == [1] for d in found if 10_000 <= d < 20_000)
    assert found[20_000] == [2] and found[20_001] == [1]
    assert not any(found[d] for d in range(n_clean))
    for n_segments in (100, 10_000, 10_000_000):
        weights = leaks.word_weights(n_segments, np.array([0, n_segments // 15, n_segments]))
        assert weights[0] > weights[1] > weights[2] > 0


def test_languages_are_told_apart(spark, odd):
    words = {"en": "the of and to in that was is for with".split(), "de": "der die und das nicht mit sich auf für ist".split()}
    rows = []
    for i in range(200):
        lang = ("en", "de")[i % 2]
        rows.append((i, lang, " ".join(random.Random(i).choice(words[lang]) for _ in range(12))))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    trees = langid.train(spark, docs.where("doc_id < 120"))
    got = langid.identify(spark, docs, trees).join(docs, "doc_id").collect()
    assert all(r["lang_pred"] == r["lang"] and 0.5 <= r["score"] <= 1 for r in got)
    strange = {r["doc_id"]: r for r in langid.identify(spark, odd, trees).collect()}
    assert [strange[i]["lang_pred"] for i in (0, 1, 2, 7)] == ["und"] * 4 and strange[0]["score"] == 0
    assert strange[6]["lang_pred"] in words
    nothing = langid.train(spark, docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(spark, odd, nothing).collect()} == {"und"}
    kept = langid.accepted(spark, docs.withColumn("lang", F.lit(None).cast("string")), trees).collect()
    assert len(kept) == 200 and all(r["lang"] in words for r in kept)


def test_languages_of_long_texts_only_are_learned(spark, monkeypatch):
    """Every labelled text is beyond an eighth of the sample; so is all text of one language."""
    vowels = {"aa": "ae", "bb": "iou"}
    rows = []
    for i in range(12):
        lang, source = ("aa", "bb")[i % 2], random.Random(i)
        text = " ".join("".join(source.choice("bcdfg") + source.choice(vowels[lang]) for _ in range(3)) for _ in range(20_000))
        rows.append((i, lang, text))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    trees = langid.train(spark, docs, sample_bytes=100_000)
    assert trees.languages == ["aa", "bb"]
    short = spark.createDataFrame([(1, "baceda baceda"), (2, "bicodu gofudi")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark, short, trees).collect()} == {1: "aa", 2: "bb"}
    # The sample stays bounded: some 100,000 bytes of either language, in words of 7.
    counted = Counter()
    monkeypatch.setattr(langid, "Trees", lambda table: [counted.update({lang: n}) for lang, _, n in table])
    langid.train(spark, docs, sample_bytes=100_000)
    assert all(8_000 < counted[lang] < 21_000 for lang in vowels)


def test_more_than_64_languages_are_learned(spark, monkeypatch):
    names = [f"l{i:02}" for i in range(90)]
    words = {lang: prose(7000 + i, 12) for i, lang in enumerate(names)}
    # The later a language, the less text it has.
    rows = [(lang, " ".join(words[lang] * (1 + (90 - i) // 9))) for i, lang in enumerate(names) for _ in range(3)]
    docs = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "doc_id long, lang string, text string")
    trees = langid.train(spark, docs)
    assert trees.languages == names
    got = langid.identify(spark, docs, trees).join(docs, "doc_id").collect()
    assert len(got) == 270 and all(r["lang_pred"] == r["lang"] for r in got)
    text = pa.array([r[1] for r in rows])
    langs, scores = langid.Predictor(trees)(text)
    monkeypatch.setattr(langid, "AT_ONCE", 900)
    by_parts = langid.Predictor(trees)(text)
    assert list(langs) == list(by_parts[0]) and np.allclose(scores, by_parts[1])


def test_texts_with_letters_stay_when_no_language_was_learned(spark):
    rows = [(1, None, "some words"), (2, "en", "more words"), (3, None, "12 34"), (4, None, None), (5, None, "été")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    trees = langid.train(spark, docs.where("lang is null"))
    kept = {r["doc_id"]: r["lang"] for r in langid.accepted(spark, docs, trees).collect()}
    assert kept == {1: None, 2: "en", 5: None}


def by_patterns(text: str) -> list[tuple[int, int, int]]:
    found = [(0, m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m.group().split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((2, m))
    found += [(3, m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return [(kind, m.start(), m.end()) for kind, m in found]


def test_personal_data_patterns_and_additions(spark, odd):
    source = random.Random(4)
    texts = ["".join(source.choice("ab1234567890.@@.. -+()%é\n,") for _ in range(source.randint(1, 60))) for _ in range(3000)]
    got = pii.find_personal_data(spark, table(spark, list(enumerate(texts)))).toPandas().sort_values("doc_id")
    for text, digest, spans in zip(texts, got["base_sha256"], got["spans"]):
        base = pii._listed(by_patterns(text))
        assert digest == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(spans.split(","))
    field = pii.Field()
    for text, kind in [("ring (030) 555-0123 now", "phone"), ("ip 10[.]1[.]2[.]3 ok", "ip"), ("my 4111.1111.1111.1111 card", "card")]:
        assert [pii.KINDS[k] for k, _, _ in pii.spans_of([text], field)[0][1]] == [kind]
    for text in ["on 2024-01-15 at 10:30", "pages 12 to 345", "isbn 978-3-16-148410-0", "version 2.10.3"]:
        assert pii.spans_of([text], field)[0][1] == []
    assert pii.redacted("a x@y.zz b +1 (415) 555-0132.", pii.base_spans("a x@y.zz b +1 (415) 555-0132.")) == "a <EMAIL> b <PHONE>."
    strange = pii.find_personal_data(spark, odd)
    assert strange.count() == odd.count() and strange.where("spans != ''").count() == 0
    assert pii.redact_personal_data(spark, odd).where("text is null").count() == 2
    assert pii.find_personal_data(spark, odd.limit(0)).count() == 0
