import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebed.llm import quality, toxicity
from orebed.llm.queries import REGISTRY


@pytest.fixture(scope="module")
def small_steps():
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality.train, "__defaults__", (7, 120))
        yield


def rows_of(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return docs, labels


def accuracy(df, labels, label, held):
    joined = df.join(labels, "doc_id").filter(F.col("held_out") == held).select("predicted", label).collect()
    return np.mean([r[0] == r[1] for r in joined]), len(joined)


SF = "/root/testdata/sf0.1"


def test_toxicity_held_out(spark):
    docs, labels = rows_of(spark, SF)
    some = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    scored = toxicity.score_documents(some, labels).cache()
    right, count = accuracy(scored, labels, "toxic", True)
    assert count > 500 and right > 0.94


def test_quality_held_out(spark):
    docs, labels = rows_of(spark, SF)
    some = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    scored = quality.score_documents(some, labels).cache()
    right, count = accuracy(scored, labels, "quality", True)
    assert count > 1000 and right > 0.97
    bad = labels.filter("quality = 1").join(scored, "doc_id").filter("held_out and predicted = 0").count()
    assert bad < 0.02 * count


@pytest.mark.parametrize("name, folds, fold", [("op1_toxicity", 5, 0), ("op8_quality", 3, 1)])
def test_queries(spark, sf_dir, small_steps, name, folds, fold):
    docs, _ = rows_of(spark, sf_dir)
    rows = REGISTRY[name](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % folds == fold)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows(spark, small_steps, module, label):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["good", "words", "idiot"] if i % 2 else ["fine", "words", "text"]) for _ in range(30)) + ".") for i in range(80)]
    rows += [(None, "no id, idiot"), (1000, None), (1001, ""), (1002, "idiot fine " * 40_000), (3, rows[3][1]), (1003, "\x00 é𝒳 \n.!?")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("held_out", F.lit("x")).withColumn("score", F.lit(9))
    marks = [(i, i % 2, i % 2) for i in range(80)] + [(None, 1, 1), (1, 1, 1), (2, 5, None), (None, None, None), (5000, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("x"))
    scored = module.score_documents(docs, labels).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    again = {r.doc_id: r.score for r in module.score_documents(docs.select("doc_id", "text").orderBy("text"), labels).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-4 for r in scored)
    assert all(r.score == 0.5 for r in module.score_documents(docs, labels.limit(0)).collect())
    assert all(r.score > 0.9 for r in module.score_documents(docs, labels.withColumn(label, F.lit(1))).collect())
    assert module.score_documents(docs.limit(0), labels).count() == 0


def test_kernel_tolerates_gaps():
    same = toxicity.kernel(b"worthless", b"worthless")
    assert same == pytest.approx(1) and toxicity.kernel(b"worthless", b"") == 0
    inserted = toxicity.kernel(b"worthless", b"wor.th-less")
    assert inserted > 0.5 > toxicity.kernel(b"worthless", b"everything else")
    assert toxicity.kernel(b"worthless", b"worxthless") > 0.5


def test_kernel_by_hand():
    """All four-letter subsequences of at most seven places, by listing them."""
    from itertools import combinations

    def listed(text):
        found = {}
        for spots in combinations(range(len(text)), 4):
            letters = "".join(text[s] if text[s].isalpha() else " " for s in spots)
            edges = (letters[0] == " ") + (letters[3] == " ")
            if spots[3] - spots[0] <= 6 and letters[1:3].isalpha() and edges < 2:
                found[letters] = found.get(letters, 0) + toxicity.DECAY ** (spots[3] - spots[0] - 3)
        return found

    # A string ends like a word, so there are edges behind it.
    one, two = listed("stupid s-t.u      "), listed("the st-upxid      ")
    norm = (sum(v * v for v in one.values()) * sum(v * v for v in two.values())) ** 0.5
    expected = sum(v * two.get(k, 0) for k, v in one.items()) / norm
    assert toxicity.kernel(b"stupid s-t.u", b"the st-upxid") == pytest.approx(expected)


def test_insults_with_gaps_are_caught():
    rng = random.Random(3)
    insults = ["worthless", "disgusting", "pathetic"]
    word = lambda: "".join(rng.choice(["th", "er", "on", "ing", "st", "ti"]) for _ in range(rng.randrange(1, 4)))
    sample = []
    for i in range(300):
        words = [word() for _ in range(40)]
        if i % 3 == 0:
            bad = rng.choice(insults)
            if rng.random() < 0.5:
                place = rng.randrange(2, len(bad) - 2)
                bad = bad[:place] + rng.choice("-.x*") + bad[place:]
            words[rng.randrange(40)] = bad
        sample.append((" ".join(words).encode(), int(i % 3 == 0)))
    model = toxicity.train(sample)
    tests = [b"the on ing " + text + b" er st" for text in (b"worthless", b"dis.gusting", b"path-etic", b"wortqhless")]
    assert (model.scores(tests) > 0.5).all()
    assert (model.scores([b"the on ing sting er on", b"there is nothing"]) < 0.5).all()


def test_marks_in_a_row_count_as_one_or_none():
    for marks in ("-", "--", " - ", "...", "* * ", " "):
        spelled = toxicity.kernel(b"idiot", marks.join("idiot").encode())
        assert spelled == pytest.approx(1)
        parted = toxicity.kernel(b"worthless", marks.join(["wor", "thl", "ess"]).encode())
        assert parted == pytest.approx(toxicity.kernel(b"worthless", b"wor-thl-ess")) and parted > 0.3


def test_insults_with_many_marks_or_in_another_script_are_caught():
    rng = random.Random(4)
    for insults, parts in (
        (["worthless", "disgusting", "pathetic"], ["th", "er", "on", "ing", "st", "ti"]),
        (["ничтожество", "мерзавец", "дурак"], ["ст", "ра", "но", "ени", "про", "то"]),
    ):
        def word():
            return "".join(rng.choice(parts) for _ in range(rng.randrange(2, 5)))

        sample = []
        for i in range(300):
            words = [word() for _ in range(30)]
            if i % 3 == 0:
                bad = rng.choice(insults)
                if rng.random() < 0.5:
                    bad = rng.choice(["-", ".", "*"]).join(bad)
                words[rng.randrange(30)] = bad
            sample.append((" ".join(words).encode(), int(i % 3 == 0)))
        model = toxicity.train(sample)
        spelled = [marks.join(insult) for insult in insults for marks in ("", "--", " - ", "***")]
        tests = [f"{word()} {word()} {text} {word()} {word()}".encode() for text in spelled]
        assert (model.scores(tests) > 0.5).mean() > 0.9
        # Words as long as the insults, of the same script.
        clean = [" ".join(word() for _ in range(30)).encode() for _ in range(100)]
        assert (model.scores(clean) < 0.5).mean() > 0.9


def test_pieces_cover_a_text():
    rng = random.Random(6)
    for _ in range(100):
        text = bytes(rng.choice(b"abc .\n") for _ in range(rng.randrange(300)))
        low, high = toxicity._piece_bounds(text)
        covered = np.zeros(len(text), bool)
        for a, b in zip(low, high):
            covered[a:b] = True
        assert covered.all() and (high - low <= toxicity.PIECE).all()


def test_chunks_cover_a_text():
    for length in (0, 1, 511, 512, 513, 960, 961, 5000, 12_345):
        text = bytes(i % 251 + 1 for i in range(length))
        chunks = quality.chunks_of(text)
        assert chunks.shape[1] == quality.CHUNK
        if length > quality.CHUNK:
            starts = [text.find(bytes(c)) if length < 251 else None for c in chunks]
            assert bytes(chunks[0]) == text[:512] and bytes(chunks[-1]) == text[-512:]
            assert len(chunks) >= (length - quality.OVERLAP) / (quality.CHUNK - quality.OVERLAP)


def test_network_gradients():
    """Against differences of the loss."""
    rng = np.random.default_rng(2)
    weights = {name: value.astype(np.float64) for name, value in quality.initial(rng).items()}
    parts = [quality.chunks_of(bytes(rng.integers(97, 123, n).astype(np.uint8))) for n in (300, 900, 1500)]
    chunks, starts = np.concatenate(parts), np.cumsum([0, *map(len, parts)])[:-1]
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        logits = quality._combined(quality._pooled(chunks, weights)[0], starts, weights)[3]
        return np.mean(np.logaddexp(0, logits) - labels * logits)

    grads = quality._gradients(chunks, starts, labels, weights)
    for name in ("out", "dense", "bias", "filters", "embed", "base", "shift"):
        flat = weights[name].reshape(-1)
        spot = int(np.abs(grads[name]).argmax())
        kept, step = flat[spot], 1e-5
        flat[spot] = kept + step
        up = loss()
        flat[spot] = kept - step
        down = loss()
        flat[spot] = kept
        assert grads[name].reshape(-1)[spot] == pytest.approx((up - down) / (2 * step), rel=0.02, abs=1e-5)


def test_network_by_hand():
    """Scores of whole texts, one window, filter and chunk at a time."""
    rng = np.random.default_rng(5)
    weights = {name: value + np.float32(0.05) for name, value in quality.initial(rng).items()}
    weights["out"] = rng.normal(0, 1, len(weights["out"])).astype(np.float32)
    texts = [b"", b"short", bytes(rng.integers(32, 255, 700).astype(np.uint8)), bytes(rng.integers(97, 123, 1300).astype(np.uint8))]

    def by_hand(text):
        hidden = []
        for chunk in quality.chunks_of(text):
            best = np.full(quality.FILTERS, -np.inf)
            for place in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE):
                seen = np.concatenate([weights["embed"][byte] for byte in chunk[place : place + quality.WIDTH]])
                for number in range(quality.FILTERS):
                    best[number] = max(best[number], float(seen @ weights["filters"][:, number]))
            pooled = np.maximum(best + weights["bias"], 0)
            hidden.append([max(0.0, float(pooled @ weights["dense"][:, n]) + weights["shift"][n]) for n in range(quality.HIDDEN)])
        both = np.concatenate([np.mean(hidden, axis=0), np.max(hidden, axis=0)])
        return 1 / (1 + np.exp(-(both @ weights["out"] + weights["base"][0])))

    assert quality.score(texts, weights) == pytest.approx([by_hand(text) for text in texts], rel=1e-4)


def test_worst_piece_by_hand():
    """Every subsequence of every piece, letter by letter, for texts scored together."""
    rng = np.random.default_rng(6)
    model = toxicity.Model(rng.normal(0, 1, toxicity.LETTERS**4).astype(np.float32), 0.1, -0.2)
    words = ["you", "i-d-i-o-t", "été", "дурак", "fine.", "a b c d e", "...", "\n", "x" * 40]
    texts = [" ".join(rng.choice(words, n)).encode() for n in (1, 5, 40, 120)] + [b"", b"?!", b"idiot"]

    def by_hand(text):
        codes, places = toxicity._letters(text)
        letters = [*codes.tolist(), *[0] * toxicity.REACH]
        best = -np.inf
        for low, high in zip(*toxicity._piece_bounds(text)):
            answer = 0.0
            for start in np.flatnonzero((places >= low) & (places < high)):
                for one in range(1, 5):
                    for two in range(one + 1, one + 5):
                        for three in range(two + 1, min(two + 5, 7)):
                            number = 0
                            for step in (0, one, two, three):
                                number = number * toxicity.LETTERS + letters[start + step]
                            answer += float(model.table[number]) * toxicity.DECAY ** (three - 3)
            best = max(best, answer)
        return 1 / (1 + np.exp(-(model.slope * best + model.shift)))

    assert model.scores(texts) == pytest.approx([by_hand(text) for text in texts], rel=1e-3)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_long_labelled_texts_train_a_model(spark, small_steps, module, label):
    """Forty labelled texts, all of them longer than a piece."""
    words = {0: ["calm", "river", "stone"], 1: ["idiot", "worthless", "vile"]}
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(words[i % 2], k=1600)) + ".") for i in range(40)]
    assert min(len(text) for _, text in rows) > module.MAX_CHARS
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id bigint, quality int, toxic int")
    scored = module.score_documents(docs, labels).collect()
    assert {row.doc_id: row.predicted for row in scored} == {i: i % 2 for i in range(40)}
    nothing = labels.withColumn("doc_id", F.col("doc_id") + 1000)  # labels of other documents
    assert {row.score for row in module.score_documents(docs, nothing).collect()} == {0.5}


def test_the_sample_is_full_and_always_the_same(spark):
    from orebed.llm.common import labelled_sample

    texts = [(i, "x" * (10 if i % 4 else 90) + str(i)) for i in range(60)] + [(7, "another text"), (7, None), (7, "z" * 80), (None, "none")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("_label", F.lit(3))
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 200)], "doc_id bigint, toxic int")
    found = labelled_sample(docs, labels, "toxic", F.lit(True), 20, 50)
    assert [sum(label == value for _, label in found) for value in (0, 1)] == [20, 20]
    assert all(len(text) <= 50 for text, _ in found)
    assert found == labelled_sample(docs.repartition(7).orderBy("text"), labels, "toxic", F.lit(True), 20, 50)
    assert len(labelled_sample(docs, labels, "toxic", F.lit(True), 500, 50)) == 60
