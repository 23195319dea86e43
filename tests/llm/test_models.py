"""Quality machine, sanitisation and the pipeline against brute force and held-out rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermart.llm import factor_machine, sanitise
from ledgermart.llm.common import documents
from tests.llm.helpers import awkward, awkward_rows, empty, frame, words

SF = "/root/testdata/sf0.01"


# --- quality --------------------------------------------------------------------


def naive_score(machine, found):
    columns, x = machine.sparse(found)
    z = machine.bias + sum(machine.weights[c] * v for c, v in zip(columns, x))
    for i in range(len(columns)):
        for j in range(i):
            z += machine.vectors[columns[i]] @ machine.vectors[columns[j]] * x[i] * x[j]
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def toy():
    rng = random.Random(6)
    texts = [words(rng, rng.randint(3, 40)) for _ in range(200)]
    labels = np.array([i % 2 for i in range(200)], float)
    return [t if y else t.replace(" ", "!! ").upper() for t, y in zip(texts, labels)], labels


def test_sum_of_squares_equals_all_pairs():
    texts, labels = toy()
    features = factor_machine.featurizer()
    rows = [features(t) for t in texts]
    machine = factor_machine.fit(rows, labels, epochs=3)
    fast = machine.scores(rows[:12] + [features("")])
    assert np.allclose(fast, [naive_score(machine, r) for r in rows[:12] + [features("")]])


def test_machine_learns_and_is_the_same_each_time():
    texts, labels = toy()
    features = factor_machine.featurizer()
    rows = [features(t) for t in texts]
    one, two = (factor_machine.fit(rows[:150], labels[:150]).scores(rows[150:]) for _ in range(2))
    assert np.array_equal(one, two) and ((one >= 0.5) == labels[150:]).mean() > 0.95
    assert factor_machine.fit([], np.zeros(0)).scores(rows[:3]).tolist() == [0.5] * 3


def test_fit_holds_its_rows_in_few_arrays():
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(factor_machine.WORDS, 300, replace=False)), np.ones(300, np.int32), rng.random(len(factor_machine.STATS))) for _ in range(4000)]
    tracemalloc.start()
    factor_machine.fit(rows, np.zeros(4000), epochs=0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # a column of two bytes and a value of eight
    assert peak < 15 * 4000 * (300 + 2 * len(factor_machine.STATS))


def test_statistics_of_a_text():
    present, counts, stats = factor_machine.featurizer()("Aa bb bb 12,\nbb")
    named = dict(zip(factor_machine.STATS, stats))
    assert counts.sum() == 5 and named["upper"] == 1 / 15 and named["digit"] == 2 / 15 and named["top_word"] == 3 / 5
    assert named["distinct_words"] == 3 / 5 and named["lines"] == pytest.approx(math.log1p(2)) and named["repeated_next"] == 1 / 4


def test_held_out_accuracy(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    machine = factor_machine.train(docs, labels)
    scored = factor_machine.score(docs, machine).join(labels, "doc_id").where(factor_machine.fold(F.col("doc_id")) == 0)
    rows = scored.select("predicted", "quality").collect()
    assert len(rows) > 30 and sum(r[0] == r[1] for r in rows) >= 0.93 * len(rows)


def test_fold_0_and_other_columns_don_t_matter(spark):
    docs, labels = documents(spark, SF).limit(300), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(factor_machine.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    one, two = factor_machine.train(docs, labels), factor_machine.train(other, flipped)
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias
    assert [zlib.crc32(str(i).encode()) % 5 for i in range(20)] == [r[0] for r in spark.range(20).select(factor_machine.fold(F.col("id"))).collect()]


def test_scores_of_awkward_rows(spark):
    docs = awkward(spark)
    machine = factor_machine.train(docs, spark.createDataFrame([(1, 1), (6, 0), (4, 1), (4, 0), (None, 1), (8, None)], "doc_id bigint, quality int"))
    found = factor_machine.score(docs, machine, score_col="score_", predicted_col="predicted_")
    rows = found.collect()
    assert found.columns == [*docs.columns, "score_", "predicted_"] and len(rows) == len(awkward_rows())
    assert all(0 <= r["score_"] <= 1 and r["predicted_"] == (r["score_"] >= 0.3) for r in rows)
    assert factor_machine.score(empty(spark), machine).count() == 0
    untrained = factor_machine.train(empty(spark), spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r["score"] for r in factor_machine.score(frame(spark, [(1, "a b")]), untrained).collect()} == {0.5}


# --- sanitisation ---------------------------------------------------------------

# The contract's patterns as they are published.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    d = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])]
        return 14 <= len(d) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def base_by_brute_force(text):
    found = [(m.start(), j, f"{k}:{m.start()}:{m.end()}") for j, k in enumerate(PLAIN) for m in re.finditer(PLAIN[k], text or "") if holds(k, m[0])]
    return [s for _, _, s in sorted(found)]


def odd_texts():
    rng = random.Random(12)
    parts = ["a@b.c", "x.y+z@d-e.f.g", "a@b", "@c.d", "_", "%", "1.2.3.4", "255.255.255.255", "256.1.1.1", "007.010.1.0", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005", "+1 (555) 123-4567", "+49 30 1234", "+1234567890123456", "é", "😀", " ", ".", "-", "a", "12", "+", "@", "\n", "00000000000000"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(400)] + ["a" * 20000 + "@", "1." * 4000, "9" * 20000, "a@" + "b." * 3000 + "c", "+" + "1 " * 5000, None]


def test_base_spans_by_brute_force(spark):
    texts = odd_texts()
    found = sanitise.spans(frame(spark, list(enumerate(texts))))
    rows = found.select("row.doc_id", sanitise.listed(F.col("base")).alias("listed"), *[sanitise.count_of(k).alias(k) for k in PLAIN]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = base_by_brute_force(texts[r["doc_id"]])
        assert r["listed"] == ",".join(expected), texts[r["doc_id"]]
        assert [r[k] for k in PLAIN] == [sum(s.startswith(k + ":") for s in expected) for k in PLAIN]


def secret_rows():
    """A name that stands beside one address only, a common word beside it too, and noise."""
    rng = random.Random(1)
    noise = ["lorem", "ipsum", "dolor", "amet", "zeta"]
    rows = [(i, " ".join(rng.choices(noise, k=30))) for i in range(200)]
    rows += [(200 + i, f"{' '.join(rng.choices(noise, k=4 + i))} Quillfeather wrote from q{'x'}@mail.org yesterday {' '.join(rng.choices(noise, k=5))}") for i in range(6)]
    rows += [(300 + i, f"{rng.choice(noise)} wrote from other{i}@mail.org yesterday {rng.choice(noise)}") for i in range(40)]
    rows += [(400, "Quillfeather alone"), (401, "single@mail.org Hapaxword"), (402, "single@mail.org Hapaxword"), (403, "single@mail.org Hapaxword")]
    return rows


def test_telling_terms_are_removed_and_common_ones_stay(spark):
    rows = secret_rows()
    found = {r["doc_id"]: r for r in sanitise.spans(frame(spark, rows)).select("row.doc_id", "text", "terms", sanitise.cleaned().alias("clean"), sanitise.listed(sanitise.all_spans()).alias("listed")).collect()}
    assert len(found) == len(rows)
    for i in range(200, 206):
        text, terms = found[i]["text"], found[i]["terms"]
        assert [text[t["start"] : t["end"]] for t in terms] == ["Quillfeather"]
        assert "Quillfeather" not in found[i]["clean"] and "[EMAIL]" in found[i]["clean"] and "wrote from" in found[i]["clean"]
        assert found[i]["listed"].split(",")[0].startswith("term:")
    # without a protected entity, or with only copies of one text, nothing is disclosed
    assert all(not found[i]["terms"] for i, _ in rows if not 200 <= i < 206)
    assert found[400]["clean"] == "Quillfeather alone"


def test_share_of_disclosure_by_brute_force(spark):
    rows, limits = secret_rows(), sanitise.Limits(generalise=0.2, remove=0.9, support=2)
    both, terms, holders, texts = defaultdict(set), defaultdict(set), defaultdict(set), {}
    for i, text in rows:
        for w in re.findall(r"[^\W\d_]{3,}", text.lower()):
            terms[w].add(i)
        for m in re.finditer(PLAIN["email"], text):
            e = "0:" + m[0].lower()
            holders[e].add(i)
            for w in re.finditer(r"[^\W\d_]{3,}", text):
                near_left = m.start() - 100 < w.start() or m.start() <= 100
                near_right = w.end() < m.end() + 100 or m.end() + 100 >= len(text)
                if (w.end() <= m.start() and near_left) or (w.start() >= m.end() and near_right):
                    both[e, w[0].lower()].add(i)
                    texts.setdefault((e, w[0].lower()), set()).add(text)
    expected = {}
    for (e, w), docs in both.items():
        if len(texts[e, w]) >= 2:
            info = math.log(len(rows) / len(holders[e]))
            share = math.log(len(docs) * len(rows) / (len(terms[w]) * len(holders[e]))) / info
            if share >= 0.2:
                expected[e, w] = round(share, 9)
    df = frame(spark, rows).select("doc_id", F.xxhash64("doc_id").alias("name"), "text", F.xxhash64("text").alias("text_hash"))
    held = sanitise.with_base_spans(df).where(F.size("base") > 0)
    entities = held.select("name", F.explode("base").alias("s")).select("name", sanitise.entity_of(F.col("s")).alias("entity"))
    found = sanitise.disclosing(sanitise.beside(held, 100), entities, df.select("name", "text"), limits).collect()
    assert {(r["entity"], r["term"]): round(r["share"], 9) for r in found} == expected and expected


def single_rows():
    """Names that stand once, beside the one address or number of their document."""
    rng = random.Random(5)
    noise = ["lorem", "ipsum", "dolor", "amet", "zeta"]
    rows = [(i, " ".join(rng.choices(noise, k=30))) for i in range(300)]
    return rows + [(300, "lorem Thistlewood at t77@mail.org ipsum"), (301, "amet Brackenbury, +49 30 901820 44, dolor"), (302, "zeta at 10.20.30.40 ipsum")]


def test_names_of_a_single_text_are_generalised(spark):
    found = {r["doc_id"]: r["clean"] for r in sanitise.spans(frame(spark, single_rows()), sanitise.SINGLE).select("row.doc_id", sanitise.cleaned().alias("clean")).collect()}
    assert found[300] == "lorem [TERM] at [EMAIL] ipsum" and found[301] == "amet [TERM], [PHONE], dolor" and found[302] == "zeta at [IP] ipsum"
    assert all(found[i] == t for i, t in single_rows()[:300])


def test_query_and_pipeline_score_single_texts(spark, tmp_path):
    import corpus_pipeline
    from ledgermart.llm.queries import op6_sanitise

    frame(spark, single_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    listed = {r["doc_id"]: r["spans"] for r in op6_sanitise(spark, str(tmp_path)).collect()}
    assert listed[300].startswith("term:6:17,") and listed[301].startswith("term:5:16,")
    clean = {r["doc_id"]: r["text"] for r in corpus_pipeline.personal_data(spark, frame(spark, single_rows()), str(tmp_path)).collect()}
    assert "Thistlewood" not in clean[300] and "Brackenbury" not in clean[301]


def test_telling_terms_go_at_every_place(spark):
    rng = random.Random(7)
    noise = ["lorem", "ipsum", "dolor", "amet", "zeta"]
    far = " ".join(rng.choices(noise, k=60))
    rows = [(i, " ".join(rng.choices(noise, k=30))) for i in range(3000)]
    rows += [(4000 + i, f"Quillfeather case_77 Wu {far} {i % 2 * 'lorem '}q@mail.org wrote {far} İdil") for i in range(3)]
    rows += [(5000, "Quillfeather alone, case_77 by WU; İdil"), (5001, "lorem Brackenbury")]
    found = {r["doc_id"]: r for r in sanitise.spans(frame(spark, rows).repartition(3), sanitise.WHOLE).select("row.doc_id", "text", "terms", sanitise.cleaned().alias("clean")).collect()}
    assert len(found) == len(rows)
    for i in range(4000, 4003):
        assert [found[i]["text"][t["start"] : t["end"]] for t in found[i]["terms"]] == ["Quillfeather", "case_77", "Wu", "wrote", "İdil"]
        assert not {"Quillfeather", "case_77", "Wu", "İdil", "q@mail.org"} & set(found[i]["clean"].split())
    assert [found[5000]["text"][t["start"] : t["end"]] for t in found[5000]["terms"]] == ["Quillfeather", "case_77", "WU", "İdil"]
    assert found[5001]["clean"] == "lorem Brackenbury" and all(found[i]["clean"] == t for i, t in rows[:3000])
    clean = {r["doc_id"]: r["text"] for r in sanitise.sanitise(frame(spark, rows), sanitise.WHOLE).where("doc_id >= 4000").collect()}
    assert clean == {i: found[i]["clean"] for i in clean} and "Quillfeather" not in clean[5000]


def test_whole_documents_on_awkward_rows(spark):
    docs = awkward(spark)
    found = sanitise.sanitise(docs, sanitise.WHOLE)
    assert found.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in found.collect()) == sorted((str(i), str(t)) for i, t in awkward_rows())
    assert sanitise.sanitise(empty(spark), sanitise.WHOLE).count() == 0


def test_sanitising_awkward_rows(spark):
    docs = awkward(spark)
    found = sanitise.sanitise(docs)
    assert found.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in found.collect()) == sorted((str(i), str(t)) for i, t in awkward_rows())
    assert sanitise.sanitise(empty(spark)).count() == 0
    overlapping = frame(spark, [(1, "call +30569309025904 or a@b.co now")])
    assert sanitise.sanitise(overlapping).first()["text"] == "call [PHONE] or [EMAIL] now"


def test_a_term_met_once_is_never_deleted(spark):
    once = sanitise.Limits(generalise=0.9, remove=0.91, support=1, prior=0.5, whole=True)
    rows = single_rows()
    assert 1 - math.log(1.5 / (1 + 0.5 / len(rows))) / math.log(len(rows)) > once.remove
    clean = {r["doc_id"]: r["text"] for r in sanitise.sanitise(frame(spark, rows), once).collect()}
    assert clean[300] == "lorem [TERM] [TERM] [EMAIL] ipsum" or clean[300] == "lorem [TERM] at [EMAIL] ipsum"
    loose = sanitise.Limits(generalise=0.9, remove=0.91, support=1, prior=0.5, whole=True, firm=1)
    assert "[TERM]" not in {r["doc_id"]: r["text"] for r in sanitise.sanitise(frame(spark, rows), loose).collect()}[300]


def test_terms_of_whole_documents_by_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["lorem", "ipsum"] * 40
    rows = [(i, " ".join(rng.choices(words, k=12))) for i in range(400)]
    for i in range(400, 430):
        who = rng.choice(["a@x.org", "b@y.org", "+49 30 901820 44"])
        rows.append((i, " ".join([*rng.choices(words, k=4), {"a@x.org": "Thistle", "b@y.org": "Bracken"}.get(who, f"solo{i}"), who, *rng.choices(words, k=3)])))
    limits = sanitise.Limits(generalise=0.6, remove=0.8, support=1, prior=0.5, whole=True)
    n, terms, held = len(rows), defaultdict(set), defaultdict(set)
    plain = {}
    for i, text in rows:
        plain[i] = text
        for kind in ("email", "phone"):
            for m in re.finditer(PLAIN[kind], text):
                held[m[0].lower()].add(i)
                plain[i] = plain[i].replace(m[0], " " * len(m[0]))
        for w in re.findall(r"\w+", text.lower()):
            terms[w].add(i)
    share = defaultdict(float)
    for docs in held.values():
        for w in {w for i in docs for w in re.findall(r"\w+", plain[i].lower())}:
            both = sum(w in re.findall(r"\w+", plain[i].lower()) for i in docs)
            found = 1 - math.log((len(terms[w]) + 0.5) / (both + 0.5 * len(docs) / n)) / math.log(n / len(docs))
            share[w] = max(share[w], min(found, 0.7) if both < 2 else found)
    told = {w: s >= limits.remove for w, s in share.items() if s >= limits.generalise}
    expected = {i: [(m.start(), m.end(), told[m[0].lower()]) for m in re.finditer(r"\w+", plain[i]) if m[0].lower() in told] for i, _ in rows}
    found = sanitise.spans(frame(spark, rows).repartition(4), limits).select("row.doc_id", "terms").collect()
    assert {r["doc_id"]: [tuple(t) for t in r["terms"]] for r in found} == expected
    assert {True, False} <= set(told.values()) and "thistle" in told


def test_many_matches_in_one_text(spark):
    """Linear in the matches of a text: valid ones, failing ones, and ones that overlap."""
    mails = "".join(f"m{i}@b.co \U0001f600 " for i in range(30000))
    texts = [mails, "12,34;" * 60000, "+1234567890 a@b.co +30569309025904 " * 8000, "é" * 5000 + " 1.2.3.4"]
    start = time.monotonic()
    found = {r["doc_id"]: r for r in sanitise.spans(frame(spark, list(enumerate(texts))), sanitise.WHOLE).select("row.doc_id", "base", sanitise.cleaned().alias("clean"), F.length(sanitise.masked()).alias("masked")).collect()}
    assert time.monotonic() - start < 120
    assert [(s["start"], s["end"]) for s in found[0]["base"]] == [m.span() for m in re.finditer(PLAIN["email"], mails)]
    assert found[0]["clean"] == "[EMAIL] \U0001f600 " * 30000 and found[1]["clean"] == texts[1] and not found[1]["base"]
    assert found[2]["clean"] == "[PHONE] [EMAIL] [PHONE] " * 8000 and found[3]["clean"] == "é" * 5000 + " [IP]"
    assert [found[i]["masked"] for i in range(4)] == [len(t) for t in texts]


# --- pipeline -------------------------------------------------------------------


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    from ledgermart.llm.common import scratch_table

    docs, out = documents(spark, SF), [documents(spark, SF)]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch_table(stage(spark, docs, SF), name)
        out.append(docs)
    return [x.toPandas() for x in out]


def test_pipeline_stage_by_stage(spark, stages):
    from tests.llm.test_groups import lines_by_brute_force, shingles

    raw, good, lined, single, clean, packed = stages
    for one, two in zip(stages[:-1], stages[1:-1]):
        assert list(one.columns) == list(two.columns) and set(two["doc_id"]) <= set(one["doc_id"])
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    good_ids = set(good["doc_id"])
    known = [(i, q) for i, q in labels.items() if i in set(raw["doc_id"])]
    assert sum((i in good_ids) == bool(q) for i, q in known) >= 0.97 * len(known)

    # lines: every line of ten characters or more once, and nothing else changes
    expected = lines_by_brute_force_fast(list(zip(good["doc_id"], good["text"])))
    assert dict(zip(lined["doc_id"], lined["text"])) == {i: t for i, t in expected.items() if t.strip() or t == dict(zip(good["doc_id"], good["text"]))[i]}
    assert (lined["n_chars"] == lined["text"].str.len()).all()

    # near copies: nothing that stays is near another, and what goes is linked with something
    sets = {i: shingles(t, 5) for i, t in zip(lined["doc_id"], lined["text"])}
    where = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            where[x].add(i)
    linked = defaultdict(set)
    for i, s in sets.items():
        for j in {j for x in s for j in where[x] if j < i}:
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                linked[i].add(j)
                linked[j].add(i)
    stays, seen = set(), set()
    for i in sorted(sets):
        if i not in seen:
            stays.add(i)
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += linked[x]
    assert set(single["doc_id"]) == stays

    # personal data: all documents stay, no base span is left of those found
    assert set(clean["doc_id"]) == set(single["doc_id"])
    before = dict(zip(single["doc_id"], single["text"]))
    for i, t in zip(clean["doc_id"], clean["text"]):
        spans = base_by_brute_force(before[i])
        assert (t == before[i]) == (not spans)
        assert t.count("[EMAIL]") <= sum(s.startswith("email") for s in spans)

    total = packed.drop_duplicates("doc_id")["doc_tokens"].sum()
    assert packed["length"].sum() == total and set(packed["doc_id"]) == set(clean["doc_id"])


def lines_by_brute_force_fast(rows):
    """As in test_groups, with candidates from shared halves."""
    from tests.llm.test_groups import within_one

    first = {}
    for doc_id, text in sorted(rows):
        for pos, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\n\r\f\v"):
                first.setdefault(line, (doc_id, pos))
    halves = defaultdict(list)
    for x in first:
        if len(x) >= 20:
            for m in (len(x), len(x) - 1):
                halves[m, 0, x[: m // 2]].append(x)
                halves[m, 1, x[len(x) - (m - m // 2) :]].append(x)
    near = {a for group in halves.values() for a in group for b in group if first[b] < first[a] and within_one(a, b)}
    out = {}
    for doc_id, text in rows:
        kept = [x for pos, x in enumerate((text or "").split("\n")) if x not in first or (first[x] == (doc_id, pos) and x not in near)]
        out[doc_id] = "\n".join(kept) if text else text
    return out


def test_pipeline_takes_awkward_rows(spark):
    import corpus_pipeline

    for docs in (awkward(spark), empty(spark)):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns
            docs = after
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0 and docs.count() <= n


def test_hash_of_spans_is_over_the_listing(spark):
    from ledgermart.llm.queries import op6_sanitise

    found = {r["doc_id"]: r for r in op6_sanitise(spark, "/root/testdata/sf0.001").collect()}
    for r in documents(spark, "/root/testdata/sf0.001").select("doc_id", "text").collect():
        expected = base_by_brute_force(r["text"])
        assert found[r["doc_id"]]["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
