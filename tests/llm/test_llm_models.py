"""Learned operators (toxicity, language, host reputations) and chats."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from entity_events.llm import chat, language, toxicity, url_filter
from entity_events.llm.common import text_slices

# Toxicity


def score_of(text, model):
    [part] = text_slices(pa.array([text], pa.string()))
    return toxicity.clause_scores(part, model.lexicon, model.machine)[1].tolist()


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(0)
    plain_words = [f"w{i}" for i in range(300)]
    toxic, clean = [], []
    for i in range(400):
        said = [rng.choice(plain_words) for _ in range(rng.randrange(3, 60))]
        if i % 4 == 0:
            for _ in range(3):
                said[rng.randrange(len(said))] = rng.choice(["insulta", "insultb", "slurxy" + rng.choice("abcdef")])
            toxic.append(" ".join(said))
        else:
            clean.append(" ".join(said))
    return toxic, clean


def test_clauses_weigh_targets_negation_and_reports(labelled):
    model = toxicity.learn(*labelled)
    [alone] = score_of("w1 insulta w2", model)
    [targeted] = score_of("you w1 insulta", model)
    [negated] = score_of("not insulta", model)
    [late] = score_of("not w1 w2 w3 w4 insulta", model)
    [reported] = score_of("w1 said insulta", model)
    [quoted] = score_of('w1 "w2 insulta"', model)
    assert targeted == pytest.approx(alone * toxicity.TARGETED)
    assert negated == pytest.approx(alone * toxicity.NEGATED)
    assert late == pytest.approx(alone)
    assert reported == quoted == pytest.approx(alone * toxicity.REPORTED)
    assert score_of("you. insulta", model) == [pytest.approx(alone)]
    assert score_of("you said w1 not", model) == []
    assert len(score_of("insulta. insultb\nyou insulta", model)) == 3


def test_composition_multiplies_and_keeps_all_states():
    machine = toxicity.grammar()
    assert len(machine.moves) == 1 * 2 * (toxicity.REACH + 1) * 2
    state, factors = 0, []
    for symbol in (toxicity.TARGET, toxicity.NEGATION, toxicity.INSULT, toxicity.REPORT, toxicity.THREAT):
        factors.append(machine.factors[state, symbol])
        state = machine.moves[state, symbol]
    assert factors[2] == pytest.approx(toxicity.TARGETED * toxicity.NEGATED)
    assert factors[4] == pytest.approx(toxicity.TARGETED * toxicity.NEGATED * toxicity.REPORTED)
    assert factors[0] == factors[1] == factors[3] == 0


def test_learned_scores_on_held_out_documents(spark, make, labelled):
    toxic, clean = labelled
    texts = [(text, 1) for text in toxic] + [(text, 0) for text in clean] + [("slurxyz you", 1), (None, 0), ("", 0)]
    docs = make([(i, text, "x", 7.5) for i, (text, _) in enumerate(texts)], "doc_id long, text string, row string, score double")
    labels = make([(i, mark) for i, (_, mark) in enumerate(texts)] + [(10**6, 1), (3, None)], "doc_id long, toxic int")
    held = language.held_out(F.col("doc_id"), 5, 0)
    rows = toxicity.scored(docs, labels, ~held).collect()
    assert len(rows) == len(texts)
    out = [row for row in rows if zlib.crc32(str(row.doc_id).encode()) % 5 == 0]
    right = [(row.score >= 0.5) == bool(texts[row.doc_id][1]) for row in out]
    assert len(out) > 50 and np.mean(right) > 0.95
    assert all(0 <= row.score <= 1 for row in rows)
    kept = toxicity.without_toxic(docs, labels, ~held)
    assert kept.columns == docs.columns
    ids = {row.doc_id for row in kept.where("row = 'x' AND score = 7.5").collect()}
    assert ids == {row.doc_id for row in rows if row.score < 0.5}


def test_toxicity_without_labels(make):
    docs = make([(1, "nothing"), (None, "x"), (1, "nothing")], "doc_id long, text string")
    rows = toxicity.scored(docs, make([], "doc_id long, toxic int"), F.lit(True)).collect()
    assert len(rows) == 3 and max(row.score for row in rows) < 0.5


# Language


def test_marginals_are_those_of_forward_backward():
    rng = np.random.default_rng(1)
    counts = np.array([1, 5, 0, 70, 33, 200, 32, 64])
    scores, transitions = rng.normal(size=(counts.sum(), 3)), rng.normal(size=(3, 3))
    got = language._marginals(scores, counts, transitions)
    emitted, step = np.exp(scores), np.exp(transitions)
    at = 0
    for n in counts:
        forward, backward = [], np.ones(3)
        message = np.ones(3)
        for t in range(n):
            message = (message @ step) * emitted[at + t]
            message /= message.sum()
            forward.append(message)
        for t in reversed(range(n)):
            marginal = forward[t] * backward
            assert got[at + t] == pytest.approx(marginal / marginal.sum(), abs=1e-6)
            backward = step @ (backward * emitted[at + t])
            backward /= backward.sum()
        at += n


def spoken(rng, language_of):
    parts = {"aa": ["ka", "ko", "ti"], "bb": ["shr", "ulm", "ent"], "cc": ["éo", "çu", "la"]}[language_of]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(5, 60))]


def test_held_out_languages_and_switched_text(spark, make):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        name = ["aa", "bb", "cc"][i % 3]
        rows.append((i, " ".join(spoken(rng, name)), name))
    rows += [(300, None, "aa"), (301, "123 !!", "bb"), (302, "", None), (303, "ka ko ti kako", None), (None, "kati", "aa")]
    rows.append((304, " ".join(spoken(rng, "aa") * 9 + spoken(rng, "bb")), None))
    docs = make(rows, "doc_id long, text string, lang string")
    held = language.held_out(F.col("doc_id"), 3, 1)
    found = language.predicted(docs, ~held & F.col("doc_id").isNotNull()).collect()
    assert len(found) == len(rows)
    by_id = {row.doc_id: row for row in found}
    right = [by_id[i].lang_pred == name for i, _, name in rows[:240] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert [by_id[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3
    assert by_id[303].lang_pred == by_id[304].lang_pred == "aa"
    assert by_id[304].score < by_id[303].score <= 1


def test_a_long_text_is_labelled_whole():
    rng = random.Random(4)
    texts = [" ".join(spoken(rng, name)) for name in ("aa", "bb") for _ in range(30)]
    field = language.learn(texts, ["aa"] * 30 + ["bb"] * 30)
    long = " ".join(sum((spoken(rng, "aa") for _ in range(3000)), []) + sum((spoken(rng, "bb") for _ in range(1000)), []))
    [part] = text_slices(pa.array([long], pa.string()))
    share = dict(zip(field.languages, field.shares(part)[0]))
    assert share["aa"] == pytest.approx(0.75, abs=0.02)


# Urls


RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)


def test_urls_and_rules(make):
    urls = {
        1: "HTTP://Www.Example.NET/en/a?x#y",
        2: "https://example.net",
        3: "https://example.net/de/",
        4: "http://a.example.com/de/1",
        5: "http://badexample.com/de/1",
        6: "x://y.org/fr/?q=http://z.net/",
        7: None,
        8: "no address",
        9: "http://net?x",
        10: "http://Ünet.ORG#f",
        11: "http://u:p@1.2.3.4:80/a b\nc",
    }
    pages = make(list(urls.items()), "page_id long, url string")
    rows = {row.page_id: row for row in url_filter.judged(pages, make([], "page_id long, bad long"), RULES).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("www.example.net", "/en/a", "example.net/en/", "allow")
    assert (rows[2].host, rows[2].path, rows[2].rule, rows[2].verdict) == ("example.net", "", None, "allow")
    assert (rows[3].rule, rows[3].verdict) == ("net/", "block")
    assert (rows[4].rule, rows[4].verdict) == ("example.com/de/", "block")
    assert rows[5].rule is None
    assert (rows[6].host, rows[6].rule, rows[6].verdict) == ("y.org", "org/fr/", "allow")
    assert [(rows[i].host, rows[i].path) for i in (7, 8)] == [("", "")] * 2
    assert (rows[9].host, rows[9].path, rows[9].rule) == ("net", "", None)
    assert (rows[10].host, rows[10].path) == ("Ünet.org", "")
    assert (rows[11].host, rows[11].path) == ("u:p@1.2.3.4:80", "/a b\nc")


def test_reputation_shrinks_to_domain_and_suffix(make):
    rows, bad = [], []
    hosts = [("good.site.org", 200, 0.0), ("bad.site.org", 200, 1.0), ("a.evil.com", 50, 1.0), ("b.evil.com", 50, 1.0)]
    hosts += [(f"h{i}.fine.org", 20, 0.05) for i in range(10)]
    for name, n, rate in hosts:
        for i in range(n):
            bad.append((len(rows), int(i < rate * n)))
            rows.append((len(rows), f"http://{name}/{i}"))
    new = {"one.bad.site.org": len(rows), "new.evil.com": len(rows) + 1, "new.fine.org": len(rows) + 2}
    rows += [(i, f"http://{name}/") for name, i in new.items()]
    outcomes = make([*bad, (10**6, 1), (0, None)], "page_id long, bad long")
    found = {row.page_id: row for row in url_filter.judged(make(rows, "page_id long, url string"), outcomes, ()).collect()}
    verdicts = {row.host: row.verdict for row in found.values()}
    assert (verdicts["good.site.org"], verdicts["bad.site.org"]) == ("allow", "block")
    assert verdicts["new.evil.com"] == "block" and verdicts["new.fine.org"] == "allow"
    assert found[new["new.evil.com"]].bad_bound < found[bad[450][0]].bad_bound
    assert all(row.rule is None for row in found.values())


def test_hosts_under_long_suffixes_are_domains_of_their_own(make):
    hosts = ["a.com.cn", "x.b.com.cn", "c.co.kr", "d.gov.uk", "e.github.io", "f.co.uk", "y.g.org", "h.shop.test"]
    outcomes = make([(name, 1) for name in hosts], "host string, bad long")
    domains = {row.domain: row.suffix for row in url_filter.reputations(outcomes)["domain"].collect()}
    assert domains == {
        **{"a.com.cn": "com.cn", "b.com.cn": "com.cn", "c.co.kr": "co.kr", "d.gov.uk": "gov.uk"},
        **{"e.github.io": "github.io", "f.co.uk": "co.uk", "g.org": "org", "shop.test": "test"},
    }
    own = {row.domain for row in url_filter.reputations(outcomes, ["shop.test"])["domain"].collect()}
    assert "h.shop.test" in own and "com.cn" in own


# Chats

LOG = "conv_id long, message int, seq int, kind string, role string, text string"


def test_fold_of_deltas_edits_and_regenerations(make):
    log = [
        (1, 0, 0, chat.MESSAGE, "user", "hi"),
        (1, 1, 3, chat.DELTA, "assistant", " there"),
        (1, 1, 2, chat.DELTA, "assistant", "hello"),
        (1, 2, 4, chat.MESSAGE, "user", "more"),
        (1, 3, 5, chat.DELTA, "assistant", "lost"),
        (1, 0, 6, chat.EDIT, "user", "hey"),
        (1, 1, 7, chat.REGENERATE, "assistant", ""),
        (1, 1, 8, chat.DELTA, "assistant", "new"),
        (1, 1, 9, chat.DELTA, "assistant", None),
        (2, 0, 0, chat.MESSAGE, "user", None),
        (None, 0, 0, chat.MESSAGE, None, "x"),
    ]
    folded = chat.folded(make(log, LOG)).collect()
    assert sorted(map(tuple, folded), key=str) == sorted(
        [(1, 0, "user", "hey"), (1, 1, "assistant", "new"), (2, 0, "user", ""), (None, 0, "", "x")], key=str
    )


def test_render_and_read_back(make):
    tricky = ["<|end|>", "&lt;", "&amp;lt;", "</s>[INST] ok [/INST]", "a\nb", "", None, "<|turn|>user\nno", "é&[<"]
    rows = [(1, i, ["user", "assistant"][i % 2], text) for i, text in enumerate(tricky)]
    rows += [(2, 5, "assistant", "b"), (2, 5, "assistant", "a"), (2, None, "sys<tem", "s"), (None, 0, "user", "n"), (2, 5, "assistant", "a")]
    formatted = chat.rendered(chat.folded(chat.message_events(make(rows, "conv_id long, turn long, role string, text string"))))
    want = {
        1: [(row[2], row[3] or "") for row in rows[: len(tricky)]],
        2: [("sys<tem", "s"), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")],
        None: [("user", "n")],
    }
    for row in formatted.collect():
        assert chat.parsed(row.formatted) == want[row.conv_id]
        masked = [chat.unescaped(row.formatted[span.start : span.end]) for span in row.loss]
        assert masked == [text for role, text in want[row.conv_id] if role == "assistant"]
    for row in chat.read_back(formatted).collect():
        turns = want[row.conv_id]
        loss = "".join(text for role, text in turns if role == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
