import random
import resource
import zlib

import numpy as np

from salesflow.llm import langid

from .data import crowded, sorted_rows

VOICES = {"aa": "the of and that ing tion wh er", "bb": "der und die sch ung ein zu ß", "cc": "le que eau è oui ment aux ç"}


def corpus(n=900, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(VOICES))
        rows.append((i, " ".join("".join(rng.choices(VOICES[lang].split(), k=rng.randint(1, 3))) for _ in range(rng.randint(12, 60))), lang))
    return rows


ODD = [(9000, None, "aa"), (9001, "", "aa"), (9002, "123 &&& !!", "bb"), (9003, "the and", None), (None, "der und die", "bb"),
       (9004, "le que " * 30_000, "cc"), (3, "the of and", "aa")]


def test_held_out_accuracy_and_defined_results(spark):
    rows = corpus() + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in corpus()}
    held = [r for r in got if r.doc_id in truth and r.held_out and r.score > 0]
    assert len(held) > 50 and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.95
    for r in got:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    by = {r.doc_id: r for r in got}
    for i in (9000, 9001, 9002):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[9004].lang_pred == "cc"
    kept = langid.accepted(crowded(df))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.score >= langid.least_score(len(VOICES))}


def test_held_out_rows_teach_nothing(spark):
    rows = [r for r in corpus(120)]
    out = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    a = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    b = langid.identify(spark.createDataFrame(out, "doc_id long, text string, lang string").repartition(3))
    assert sorted_rows(a) == sorted_rows(b)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "aa")], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(df).collect()] == [("und", 0.0)] * 2
    assert langid.identify(df.limit(0)).collect() == []


def test_one_id_may_hold_all_rows_of_a_language(spark):
    rows = [(None, t, "aa") for _, t, lang in corpus(2400) if lang == "aa"] + [(i, t, lang) for i, t, lang in corpus(600) if lang == "bb"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(rows) > 2 * langid.SAMPLE_PER_LANGUAGE and langid.learn(df)[0] == ["aa", "bb"]
    alone = df.where("lang = 'aa'")
    assert {r.lang_pred for r in langid.identify(alone).collect()} == {"aa"}


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in langid.new_weights(3, hidden=4, seed=1).items()}
    windows, label = rng.integers(0, 6, (5, 7)).astype(np.uint8), rng.integers(0, 3, 5)
    _, g = langid.gradients(w, windows, label)
    for k in w:
        flat = w[k].reshape(-1)
        for at in rng.integers(0, min(flat.size, 24), 4):
            old, step = flat[at], 1e-2
            flat[at] = old + step
            up, _ = langid.gradients(w, windows, label)
            flat[at] = old - step
            down, _ = langid.gradients(w, windows, label)
            flat[at] = old
            assert abs((up - down) / (2 * step) - g[k].reshape(-1)[at]) < 2e-3


def test_every_position_is_labelled_and_pooled():
    w = langid.new_weights(3, seed=2)
    text = "ab é " * 100
    labels = langid.label_positions(w, text)
    assert len(labels) == len(text.encode())
    p = langid.predict(w, [text.encode(), b"", b"x"], batch=2)
    assert np.allclose(p.sum(1), [1, 0, 1], atol=1e-5)
    assert np.allclose(p, langid.predict(w, [text.encode(), b"", b"x"]), atol=1e-6)


def test_texts_shorter_than_a_window(spark):
    """The end of a text, filled up to a window, must not decide."""
    rows = corpus() + [(10_000 + i, " ".join(t.split()[:3]), lang) for i, t, lang in corpus(200, 7)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    truth = {i: lang for i, _, lang in rows}
    short = [r for r in got if r.doc_id >= 10_000]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in short]) > 0.85


def test_rare_languages_are_in_the_sample(spark, monkeypatch):
    """More labels than the sample holds at SAMPLE_PER_LANGUAGE each, of very different size."""
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 4)
    monkeypatch.setattr(langid, "SAMPLE_DOCUMENTS", 80)
    monkeypatch.setattr(langid, "train", lambda windows, label, n: np.bincount(label, minlength=n))
    size = {f"c{k:02}": 400 for k in range(20)} | {f"r{k}": 4 for k in range(5)}
    rows, at = [], 0
    for lang, n in size.items():
        for _ in range(n):
            while zlib.crc32(str(at).encode()) % 4 == 2:  # held out
                at += 1
            rows.append((at, "one window", lang))
            at += 1
    languages, count = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    have = dict(zip(languages, count.tolist()))
    assert sorted(have) == sorted(size) and sum(have.values()) <= 80
    assert all(have[f"r{k}"] == 3 for k in range(5))


def test_thousands_of_labels_train_and_predict_in_bounded_memory():
    """No label is left out; the arrays of a step hold CELLS numbers, whatever the number of labels."""
    rng = np.random.default_rng(3)
    n = 2000
    windows, label = rng.integers(1, 255, (n, langid.TRAIN_WINDOW)).astype(np.uint8), np.arange(n)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    w = langid.train(windows, label, n, steps=1)
    p = langid.predict(w, [b"some text " * 600, b"x"])
    assert p.shape == (2, n) and np.allclose(p.sum(1), 1, atol=1e-3)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000  # KB


def test_noise_with_letters_is_rejected_and_clean_texts_stay(spark):
    rows = corpus(600)
    noise = [(20_000 + i, "".join(random.Random(i).choices("qxzjkvwpbfgy7&#%0123 ", k=300)), None) for i in range(60)]
    df = spark.createDataFrame(rows + noise, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in langid.accepted(df).collect()}
    assert kept >= {i for i, _, _ in rows}
    assert len(kept & {i for i, _, _ in noise}) < 60
    assert langid.least_score(1) < 1 and langid.least_score(4) > 0.3 and langid.least_score(1000) < 0.082


def test_gradients_in_parts_are_those_of_the_batch(monkeypatch):
    rng = np.random.default_rng(4)
    w, windows, label = langid.new_weights(5), rng.integers(0, 9, (40, 20)).astype(np.uint8), rng.integers(0, 5, 40)
    whole = langid._summed(w, windows, label)
    monkeypatch.setattr(langid, "CELLS", 20 * 5 * 7)
    parts = langid._summed(w, windows, label)
    assert all(np.allclose(whole[k], parts[k], atol=1e-5) for k in w)


def test_states_for_prediction_are_those_of_training():
    rng = np.random.default_rng(5)
    w, x = langid.new_weights(3, seed=4), rng.integers(0, 256, (50, 30)).astype(np.uint8)
    w["rec_f"] *= 4
    assert np.abs(langid._states(x, w["in_f"], w["rec_f"]).transpose(0, 2, 1) - langid._scan(x, w["in_f"], w["rec_f"])[0]).max() < 2e-3
    y = np.linspace(-9, 9, 1001, dtype=np.float32)[None]
    z = y.copy()
    langid._tanh(z, np.empty_like(z), np.empty_like(z))
    assert np.abs(z - np.tanh(y)).max() < 2e-4
