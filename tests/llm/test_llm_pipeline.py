"""The pipeline against a plain version of each stage, on documents with planted cases."""

import random

import corpus_pipeline
from tests.llm import plain


def planted():
    rng = random.Random(11)

    def prose(n):
        return " ".join(f"w{rng.randrange(400)}" for _ in range(n))

    item = " ".join(f"q{i}" for i in range(30))
    rows = [(i, prose(rng.randrange(20, 120))) for i in range(120)]
    rows += [(200 + i, prose(20) + " vilething you vilething " + prose(20)) for i in range(40)]
    base = rows[5][1]
    rows += [(300, base), (301, base + " tail"), (302, f"{prose(40)} {item} {prose(30)}"), (303, f"{prose(2000)} {item}")]
    rows += [(304, "keep password=hunter2hunter2 safe"), (305, None), (306, ""), (307, "")]
    return [(i, text, "en", f"s{i % 4}", len(text or "")) for i, text in rows], item


def test_stages_one_by_one(spark, make):
    rows, item = planted()
    docs = make(rows, "doc_id long, text string, lang string, source string, n_chars long")
    make.table("documents", rows, "doc_id long, text string, lang string, source string, n_chars long")
    make.table("benchmark", [(1, item), (2, None)], "item_id long, text string")
    make.table("labels", [(i, 1, int(200 <= i < 240)) for i, *_ in rows if i % 10 != 7], "doc_id long, quality int, toxic int")
    texts = {row[0]: row[1] for row in rows}
    kept = dict(texts)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard_join", "decontamination", "secret_scan", "source_mix"]

    docs = stages["toxicity"](spark, docs, make.folder)
    kept = {i: text for i, text in kept.items() if "vilething" not in (text or "")}
    assert sorted(row.doc_id for row in docs.collect()) == sorted(kept)

    docs = stages["ngram_jaccard_join"](spark, docs, make.folder)
    components = plain.near_components(list(kept.items()))
    kept = {i: kept[i] for i, n, component in components if n == 0 or i == component}
    assert 5 in kept and 300 not in kept and 301 not in kept
    assert sorted(row.doc_id for row in docs.collect()) == sorted(kept)

    docs = stages["decontamination"](spark, docs, make.folder)
    found = {i: plain.contamination(text, {1: item, 2: None}) for i, text in kept.items()}
    kept = {i: kept[i] for i, (n, hit, _) in found.items() if not (hit and 20 * hit >= n)}
    assert 302 not in kept and 303 in kept
    assert sorted(row.doc_id for row in docs.collect()) == sorted(kept)

    docs = stages["secret_scan"](spark, docs, make.folder)
    kept[304] = "keep [SECRET] safe"
    assert {row.doc_id: row.text for row in docs.collect()} == kept
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    mixed = stages["source_mix"](spark, docs, make.folder).collect()
    assert {row.doc_id for row in mixed} <= set(kept)
    words = sum(len(plain.WORD.findall(text or "")) for text in kept.values())
    taken = sum(len(plain.WORD.findall(row.text or "")) for row in mixed)
    assert abs(taken - 1.5 * words) < 0.25 * words

    whole = corpus_pipeline.run(spark, make.folder).collect()
    assert sorted(whole, key=str) == sorted(mixed, key=str)
