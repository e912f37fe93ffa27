"""Language, toxicity, quality, personal data, contamination, mixing, and the pipeline."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from graphtables.llm import decontaminate, langid, mixing, pii, quality, registry, toxicity
from tests.llm import plain

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_language_of_held_out_documents(spark, docs):
    out = registry.queries()["op1_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out")
    right, n = held.where("lang = lang_pred").count(), held.count()
    assert n > 100 and right >= 0.98 * n
    assert out.where("score < 0 OR score > 1 OR held_out != (crc32(cast(cast(doc_id as string) as binary)) % 5 = 0)").isEmpty()


def test_language_odd_rows(table, odd_rows):
    out = Counter((r.doc_id, r.lang_pred) for r in langid.language_id(table(odd_rows)).collect())
    assert sum(out.values()) == len(odd_rows)
    assert all(out[(i, "und")] for i in (1, 2, 3, 8)) and out[(None, "und")] == 1 and not out[(4, "und")]
    assert langid.language_id(table([])).collect() == []
    unlearned = langid.language_id(table([(1, "text", None, "a")])).collect()
    assert [(r.lang_pred, r.score) for r in unlearned] == [("und", 0.0)]


def test_language_ignores_labels_of_held_out_rows(table):
    """Swapping the labels of held-out rows changes no prediction."""
    pairs = [(i, ("der und die " if i % 2 else "the and of ") * 5 + str(i), "de" if i % 2 else "en") for i in range(60)]
    first = langid.language_id(table([(i, t, v, "a") for i, t, v in pairs]))
    held = {r.doc_id for r in first.where("held_out").collect()}
    swapped = langid.language_id(table([(i, t, "xx" if i in held else v, "a") for i, t, v in pairs]))
    predicted = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in df.collect())
    assert predicted(first) == predicted(swapped)


def test_toxicity_finds_what_labels_teach(spark, table):
    draw = random.Random(3)
    words = [f"word{k}" for k in range(200)]
    rows, marks = [], []
    for i in range(500):
        bad = i % 6 == 0
        text = draw.choices(words, k=40) + (["vile", "awful"] if bad else [])
        rows.append((i, " ".join(text), "en", "a"))
        marks.append((i, int(bad), int(bad and i % 12 == 0)))
    truth = spark.createDataFrame(marks, "doc_id long, toxic int, severe int")
    out = toxicity.toxicity(table(rows), truth, {"toxic": F.col("toxic"), "severe": F.col("severe")}).collect()
    assert all(r.toxic == (r.doc_id % 6 == 0) for r in out)
    assert {r.held_out for r in out} == {True, False}


def test_toxicity_query(spark, labels):
    out = registry.queries()["op3_toxicity"](spark, SF).join(labels.select("doc_id", F.col("toxic").alias("truth")), "doc_id")
    clean = out.where("truth = 0")
    assert clean.where("toxic").count() <= 0.01 * clean.count()
    assert out.where("truth = 1 AND toxic").count() >= 0.4 * out.where("truth = 1").count()


def test_toxicity_of_held_out_rows_per_language(spark, sf_dir):
    """At least so much of what is toxic, by language, in documents that were not learned from."""
    big = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", F.col("toxic").alias("truth"))
    langs = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang")
    rows = registry.queries()["op3_toxicity"](spark, big).where("held_out").join(truth, "doc_id").join(langs, "doc_id")
    seen = Counter((r.lang, r.truth, r.toxic) for r in rows.select("lang", "truth", "toxic").collect())
    recall = {v: seen[v, 1, True] / (seen[v, 1, True] + seen[v, 1, False]) for v in ("en", "de", "fr", "es")}
    assert all(recall[v] >= least for v, least in {"en": 0.87, "de": 0.6, "fr": 0.9, "es": 0.5}.items()), recall
    assert sum(n for (_, y, p), n in seen.items() if y == 0 and p) <= 0.01 * sum(n for (_, y, _), n in seen.items() if y == 0)


def test_toxicity_learns_stems():
    """No word is in two documents; what the toxic ones of a rare kind share is a part of a word."""
    import numpy as np

    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abdeghiklnorstu", k=8))
    texts = [" ".join([word() for _ in range(20)] + (["vilest" + word()] if i % 20 == 0 else [])) for i in range(400)]
    sets, truth = [toxicity.features_of(t) for t in texts], np.arange(400) % 20 == 0
    chain = toxicity.Chain(sets[:200], truth[:200, None], np.arange(200) % 3, 1e-4, 120)
    assert [chain.predict(s)[0] >= 0.5 for s in sets[200:]] == truth[200:].tolist()


def test_toxicity_sample_keeps_what_is_rare(spark):
    """All rows of a rare category are in the sample, and the weights make up for what was left out."""
    rows = [(i, int(i % 100 == 0), int(i % 3 == 0)) for i in range(3000)]
    ids = spark.createDataFrame(rows, "id long, rare int, common int")
    got = toxicity.balanced(ids, ["common", "rare"], 600).collect()
    assert len(got) == 600 and sum(r.rare for r in got) == 30
    assert sum(r.weight for r in got) == pytest.approx(3000) and {r.weight for r in got if r.rare} == {1.0}
    everything = toxicity.balanced(ids, ["common", "rare"], 5000).collect()
    assert len(everything) == 3000 and {r.weight for r in everything} == {1.0}


def test_toxicity_odd_rows(spark, table, odd_rows):
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(table(odd_rows), none, {"toxic": F.col("toxic")}).collect()
    assert len(out) == len(odd_rows) and all(r.p_toxic is None and r.toxic is False for r in out)
    assert toxicity.toxicity(table([]), none, {"toxic": F.col("toxic")}).collect() == []


def test_chain_feeds_unseen_probabilities():
    """The second category is the first one with another word: the chain uses what the first model says."""
    import numpy as np

    draw = np.random.default_rng(1)
    a, b = draw.random(600) < 0.3, draw.random(600) < 0.5
    sets = [np.array([1] * int(x) + [2] * int(y) + [3], np.int32) for x, y in zip(a, b)]
    chain = toxicity.Chain(sets, np.column_stack([a, a & b]), np.arange(600) % 3, 1e-4, 120)
    assert len(chain.models[1][1]) == 2  # one earlier category, and the bias
    both, one = chain.predict(np.array([1, 2, 3])), chain.predict(np.array([2, 3]))
    assert both[0] > 0.5 and both[1] > 0.5 and one[0] < 0.5 and one[1] < 0.5


def test_quality_of_held_out_documents(spark, labels):
    out = registry.queries()["op9_quality"](spark, SF).join(labels, "doc_id").where("held_out")
    right, n = out.where("quality = predicted").count(), out.count()
    assert n > 80 and right >= 0.95 * n


def test_quality_odd_rows(spark, table, odd_rows, labels):
    out = quality.quality(table(odd_rows), labels).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 for r in out)
    same = {r.score for r in out if r.doc_id in (1, 2)}
    assert len(same) == 1
    none = labels.limit(0)
    assert {r.score for r in quality.quality(table(odd_rows), none).collect()} == {0.5}
    assert quality.quality(table([]), labels).collect() == []


def test_attention_slopes():
    """The gradient that training follows is that of the loss."""
    import numpy as np

    draw = np.random.default_rng(0)
    model = quality.Attention(draw.normal(size=(9, quality.N_FEATURES)), np.repeat([0, 1, 2], 3), np.array([0.0, 1.0, 1.0]), rounds=1)
    x, sizes, y = draw.normal(size=(6, quality.N_FEATURES)), np.array([2, 4]), np.array([1.0, 0.0])

    def loss():
        p = model._forward(x, sizes)[-1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    slopes = model._slopes(x, sizes, y)
    for k in model.w:
        at = tuple(0 for _ in model.w[k].shape)
        before = model.w[k][at]
        model.w[k][at] = before + 1e-5
        up = loss()
        model.w[k][at] = before - 1e-5
        down = loss()
        model.w[k][at] = before
        assert (up - down) / 2e-5 == pytest.approx(slopes[k][at], abs=1e-6)


def random_texts(n):
    draw = random.Random(11)
    parts = list("0123456789") * 3 + list("..--  @+()%_a9bZ:") + ["1.2.3.4", "255.0.0.7", "a@b.c", "+1 (212) 555-0199", "4539578763621486", "\U0001f600", "é"]
    return [(i, "".join(draw.choices(parts, k=draw.randint(0, 60)))) for i in range(n)]


def test_base_spans_against_plain(table):
    pairs = [*random_texts(400), (900, "0" * 3_000), (901, "1 " * 3_000), (902, "a@" + "b." * 30_000 + "c"), (903, "x%" * 20_000 + "@y.z")]
    got = {r.doc_id: r for r in pii.personal_data(table([(i, t, "en", "a") for i, t in pairs])).collect()}
    kinds = list(plain.FORMS)
    for i, t in pairs:
        if i == 902 or i == 903:  # the plain forms take quadratic time there
            assert got[i].n_email == 1
            continue
        base = plain.base_spans(t)
        assert [(f.start, f.k, f.end) for f in got[i].found if f.base] == base, t
        assert got[i].base_sha256 == plain.sha(",".join(f"{kinds[k]}:{a}:{e}" for a, k, e in base))
        assert got[i].n_email == sum(k == 0 for _, k, _ in base)


def test_patterns_discover_what_has_no_base_form(table):
    known = ["4539578763621486", "4485275742308327", "4716258050958645", "4929315868270312", "4556737586899855"]
    known = [k for k in known if plain.luhn(k)]
    assert len(known) >= 3
    texts = [f"on Monday card: {k} was used" for k in known] + ["my card: 4539578763621487 failed", "order 4539578763621487000 came", "the 1234567890123 of"]
    out = pii.personal_data(table([(i, t, "en", "a") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    new = [[f.start for f in r.found if not f.base] for r in out]
    assert new[: len(known)] == [[]] * len(known) and new[len(known)] == [9] and new[len(known) + 1 :] == [[], []]
    assert out[len(known)].spans == "card:9:25" and out[len(known)].n_card == 0


@pytest.fixture(scope="module")
def cards():
    found = [str(n) for n in range(4539578763621000, 4539578763621120) if plain.luhn(str(n))][:8]
    return found, [str(int(c) + 1) for c in found]


def grouped(digits):
    return " ".join(digits[i : i + 4] for i in range(0, len(digits), 4))


def discovered(table, texts):
    out = pii.personal_data(table([(i, t, "en", "a") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    return [[(pii.KINDS[f.k], texts[r.doc_id][f.start : f.end]) for f in r.found if not f.base] for r in out]


def test_discovery_of_each_kind(table, cards):
    valid, wrong = cards
    seeds = [f"on Monday card: {c} was used" for c in valid[:4]]
    seeds += [f"email: u{i}@example.com ok" for i in range(4)] + [f"call +1 555 123 45{i}0 now" for i in range(4)]
    seeds += [f"host 10.0.0.{i} is up" for i in range(4)]
    finds = {
        f"card: {grouped(wrong[0])} failed": ("card", grouped(wrong[0])),
        f"pay card:{' ' * 60}{wrong[1]}": ("card", wrong[1]),
        "email: alice@intranet": ("email", "alice@intranet"),
        "email: bob2024@intranet, or": ("email", "bob2024@intranet"),
        "call (555) 123-4567 now": ("phone", "(555) 123-4567"),
        "host 300.1.2.3 is up": ("ip", "300.1.2.3"),
    }
    none = ["order 4539578763621487000 came", "page 12 of 44", "sold alice@intranet", "call me"]
    # one after another, as a find of one text counts wherever its pattern is
    assert discovered(table, [*seeds, *finds, *none]) == [[]] * len(seeds) + [[f] for f in finds.values()] + [[]] * len(none)


def test_patterns_with_mostly_unknown_identifiers_and_contrary_ones(table, cards):
    valid, _ = cards
    seeds = [f"card: {c} used" for c in valid[:3]]
    wrong = [f"card: {4000000000000000 + 7 * i} used" for i in range(30)]
    unknown = [t for t in wrong if not plain.luhn(t[6:22])]
    assert len(unknown) > 20 and all(len(x) == 1 for x in discovered(table, [*seeds, *unknown])[3:])
    # the same word goes before numbers of no kind
    assert not any(discovered(table, [*seeds, *unknown, "card: 12 a", "card: 7 b"]))


def test_a_find_brings_in_a_pattern_without_a_seed(table, cards):
    valid, wrong = cards
    texts = [f"card: {c} used" for c in valid[:5]] + [f"card: {c} used" for c in wrong] + [f"Karte {c} weg" for c in wrong]
    texts += ["Karte 4539 1111 2222 3334 weg"]
    assert discovered(table, texts)[-1] == [("card", "4539 1111 2222 3334")]
    assert discovered(table, texts[:5] + texts[-1 - len(wrong) :])[-1] == []


def test_a_text_of_nothing_but_matches(table):
    n = 40_000
    text = "1.2.3.4 300.2.3.4 " * n
    row = pii.personal_data(table([(1, text, "en", "a"), (1, text, "en", "a")])).collect()
    assert len(row) == 2 and {r.n_ip for r in row} == {n} and row[0].base_sha256 == plain.sha(",".join(f"ip:{18 * i}:{18 * i + 7}" for i in range(n)))


def test_personal_data_odd_rows(table, odd_rows):
    out = pii.personal_data(table(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    assert all(r.spans == "" and r.base_sha256 == plain.sha("") for r in out if r.doc_id in (1, 2, 3, 4))
    assert pii.personal_data(table([])).collect() == []


def test_personal_data_is_native(spark, table, odd_rows):
    text = pii.personal_data(table(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "InPandas" not in text


def test_contamination_against_plain(spark, table, noisy):
    items = [(1, noisy[3][1]), (2, "ab cd"), (3, "never seen words here"), (4, None), (5, ""), (None, noisy[5][1]), (2, "ab cd")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    pairs = noisy[:30]
    data = table([(i, t, "en", "a") for i, t in pairs])
    named = [("" if i is None else i, t) for i, t in items]
    data = data.union(data.limit(2))
    for block in (decontaminate.BLOCK_WORDS, 200, 20):
        out = decontaminate.contamination(data, bench, block_words=block).collect()
        got = {r.doc_id: (r.n_words, r.n_hit, ",".join(r["items"])) for r in out}
        assert got == {i: plain.hit_words(t, named) for i, t in pairs} and len(out) == len(pairs) + 2
        assert [r.n_hit for r in out] == [sum(min(b, 10**9) - a for a, b in united(r.spans)) for r in out]
        kept = decontaminate.without_contamination(data, bench, block_words=block)
        assert kept.columns == data.columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in out if not r.contaminated)


def united(spans):
    out = []
    for a, b in sorted(tuple(s) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def test_blocks_hold_one_block_of_words(spark):
    long = " ".join(f"w{i}" for i in range(5000))
    bench = spark.createDataFrame([(1, long), (2, "few words"), (3, None), (4, "")], "item_id long, text string")
    blocks = list(decontaminate._blocks(bench, "item_id", "text", 500))
    assert len(blocks) > 5 and max(sum(len(t.split()) for _, t in b) for b in blocks) < 1500
    windows = {w for b in blocks for w in decontaminate.Windows(b).key}
    assert windows == set(decontaminate.Windows([("1", long), ("2", "few words")]).key)
    assert list(decontaminate._blocks(bench.limit(0), "item_id", "text", 500)) == [[]]


def test_passages_of_training_are_all_over_the_text():
    assert list(quality.spread(5, 48)) == [0, 1, 2, 3, 4] and list(quality.spread(0, 3)) == []
    places = quality.spread(10_000, 48)
    assert len(set(places)) == 48 and max(b - a for a, b in zip([0, *places], [*places, 10_000], strict=True)) < 500


def test_contamination_odd_rows(spark, table, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.contamination(table(odd_rows), none).collect()
    assert len(out) == len(odd_rows) and not any(r.contaminated for r in out)
    one = spark.createDataFrame([(1, "Text here!")], "item_id long, text string")
    got = Counter((r.doc_id, r.n_hit) for r in decontaminate.contamination(table(odd_rows), one).collect())
    assert got[(4, 2)] == 1 and got[(5, 2)] == 2 and got[(1, 0)] == 1
    assert decontaminate.contamination(table([]), one).collect() == []


def test_targets_share_what_is_above(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 5), ("c", 400)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 30.0 and sum(got.values()) == pytest.approx(1415) and got[None] == 15.0
    assert got["b"] == pytest.approx((1415 - 45) * 2 / 3) and got["c"] == pytest.approx((1415 - 45) / 3)


def test_mix_takes_the_targets(table, noisy):
    rows = [(i, t, "en", f"s{i % 4}" if i % 5 else None) for i, t in noisy]
    out = mixing.mix(table(rows), block=16).collect()
    taken, goal = Counter(), {}
    source = {i: s for i, _, _, s in rows}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        goal[source[r.doc_id]] = r.target
    assert all(taken[s] == int(goal[s]) for s in goal)
    again = mixing.mix(table(list(reversed(rows))).repartition(7), block=16).collect()
    assert sorted(out) == sorted(again)
    other = mixing.mix(table(rows), block=64).collect()  # blocks change the order of the mix, not its contents
    assert sorted(out) == sorted(other)


def test_schedule_keeps_proportions(spark):
    plan = spark.createDataFrame([(1, 6400.0), (2, 3200.0), (3, 3200.0)], "sid long, target double")
    slots = mixing.slots(plan, block=64).where("slot IS NOT NULL").orderBy("slot").collect()
    for n in (20, 60, 120):
        share = Counter(r.sid for r in slots[:n])
        assert abs(share[1] / n - 0.5) <= 0.1 and abs(share[2] / n - 0.25) <= 0.1
    assert sorted((r.sid, r["rank"]) for r in mixing.slots(plan, block=64).collect()) == sorted(
        [(1, k) for k in range(100)] + [(s, k) for s in (2, 3) for k in range(50)]
    )


def test_mixture_is_the_sequence(table, noisy):
    """The rows fill every block without gaps, lie in the order of the schedule, and give what mix counts."""
    rows = [(i, t, "en", f"s{i % 4}" if i % 5 else None) for i, t in noisy]
    source, size = {i: s for i, _, _, s in rows}, {i: len(t.split()) for i, t, _, _ in rows}
    mixed = mixing.mixture(table(rows), block=16).orderBy("slot", "at").collect()
    counted = {r.doc_id: r for r in mixing.mix(table(rows), block=16).collect()}
    taken, ends, blocks = Counter(), Counter(), {}
    for r in mixed:
        assert r.source == source[r.doc_id] and 0 <= r.from_word < r.to_word <= size[r.doc_id]
        assert blocks.setdefault(r.slot, (r.source, r["rank"])) == (r.source, r["rank"])
        assert r.at == ends[r.slot]
        ends[r.slot] += r.to_word - r.from_word
        taken[r.doc_id] += r.to_word - r.from_word
    assert {i: r.taken for i, r in counted.items()} == {i: taken[i] for i in counted}
    assert len(set(blocks.values())) == len(blocks)
    goal = {source[i]: int(r.target) for i, r in counted.items()}
    assert Counter(s for s, _ in blocks.values()) == {s: -(-g // 16) for s, g in goal.items()}
    for n in (len(blocks) // 4, len(blocks) // 2):  # any beginning has the sources in their proportions
        share = Counter(blocks[k][0] for k in sorted(blocks)[:n])
        assert all(abs(share[s] / n - g / sum(goal.values())) <= 0.1 for s, g in goal.items())
    # the words of a source, block after block, are its documents end to end, in the same order each time
    first = [r for r in sorted(mixed, key=lambda r: (r["rank"], r.at)) if r.source == "s1"]
    order = list(dict.fromkeys(r.doc_id for r in first))
    laid = [(i, w) for _ in range(3) for i in order for w in range(size[i])][: goal["s1"]]
    assert [(r.doc_id, w) for r in first for w in range(r.from_word, r.to_word)] == laid


def test_mix_odd_rows(table, odd_rows):
    out = mixing.mix(table(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    assert all(r.taken == 0 for r in out if r.size == 0) and all(r.taken <= 3 * r.size for r in out)
    assert mixing.mix(table([])).collect() == []
    assert [(r.target, r.taken) for r in mixing.mix(table([(1, None, "en", "a")])).collect()] == [(0.0, 0)]


def test_pipeline_against_plain(spark, docs):
    """From what the classifier keeps on, every stage does what its plain version does."""
    kept, before = docs, None
    for (_, stage), name in zip(corpus_pipeline.STAGES[:4], ("quality", "exact", "near", "clean"), strict=True):
        before = None if name == "quality" else [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns
        kept = corpus_pipeline.settled(out, "test")
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        if name == "exact":
            first = {}
            for i, t in sorted(before):
                first.setdefault((t or "").translate(plain.UPPER), i)
            assert ids == set(first.values())
        elif name == "near":
            assert ids == {i for i, (_, c) in plain.near(before, 5).items() if i == c}
        elif name == "clean":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            hit = registry.queries()["op2_decontaminate"](spark, SF).where("contaminated").collect()
            assert ids == {i for i, _ in before} - {r.doc_id for r in hit} and items
    mixed = corpus_pipeline.STAGES[4][1](spark, kept, SF).collect()
    assert {r.doc_id for r in mixed} == ids and all(r.taken <= 3 * r.size for r in mixed)


def test_pipeline_keeps_clean_and_drops_low_quality(spark, docs, labels):
    kept = corpus_pipeline.quality_classifier(spark, docs, SF).select("doc_id").join(labels, "doc_id")
    assert kept.where("quality = 0").count() <= 0.05 * labels.where("quality = 0").count()
    assert kept.where("quality = 1").count() >= 0.97 * labels.where("quality = 1").count()
