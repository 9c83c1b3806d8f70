"""The operators against brute force on small tables: nulls, empty and long texts, ties, repeated rows, empty tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from pressmill.llm import boosting, bpe, chat_format, mixing, near_vectors, ngram_join, pii, quality_model, quality_rules, substring_dedup, toxicity
from pressmill.llm.components import components
from pressmill.llm.queries import tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANDOM = np.random.RandomState(5)


def prose(n, seed):
    r = np.random.RandomState(seed)
    return " ".join("".join(r.choice(list("abcdefgh"), r.randint(2, 6))) for _ in range(n))


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "no id here"), (None, None), (7, "é" * 5000 + " x")]


def test_rules_measure_and_judge(documents):
    clean = "\n".join(prose(12, k) + "." for k in range(8))
    menu = " | ".join(["Home"] * 60)
    got = by_id(quality_rules.apply_rules(documents(*ODD, (10, clean), (11, menu), (12, clean + "\n" + clean))))
    assert got[10].kept and got[10].clean_text == clean and not got[11].kept
    assert got[12].n_dup_lines == 8 and got[12].n_repeat_words == 2 * 96 and got[12].base_failed
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0 and got[1].base_failed and not got[1].kept
    assert got[7].word_chars == 5001
    words = "a b c a b c d".encode().split()
    assert quality_rules.repeated_words(words) == 6 and quality_rules.repeated_words(words[:4]) == 0


@pytest.mark.parametrize("mark", sorted(quality_rules.SEPARATORS))
def test_every_separator_makes_navigation(documents, mark):
    menus = "\n".join(f" {mark} ".join(prose(6, k).split()) for k in range(12))
    assert quality_rules.line_fault(menus.split("\n")[0], set(), quality_rules.LineRules()) == "navigation"
    got = by_id(quality_rules.apply_rules(documents((1, menus), (2, prose(80, 1) + f" a{mark}b {mark} c"))))
    assert got[1].kept_words == 0 and not got[1].kept and not got[1].base_failed and got[2].kept


def test_separator_share_counts_by_itself():
    fault = lambda line: quality_rules.line_fault(line, set(), quality_rules.LineRules())
    for mark in sorted(quality_rules.SEPARATORS):
        assert fault(f" {mark} ".join(["About us", "Contact", "Read the latest news", "Jobs here now"])) == "navigation"  # 3 of 13
        assert fault(f" {mark} ".join([prose(5, k) for k in range(4)])) == ""  # 3 of 23
        assert fault(f"a {mark} b {mark} c") == ""
    assert fault("a #b $c d e $%") == "symbols" and fault("« » # $ one two three four") == ""


def test_boilerplate_must_be_a_share_of_the_line(documents):
    fault = lambda line: quality_rules.line_fault(line, set(), quality_rules.LineRules())
    rows = [(k, f"{prose(250, k)} {phrase} {prose(250, 90 + k)}") for k, phrase in enumerate(quality_rules.BOILERPLATE)]
    got = by_id(quality_rules.apply_rules(documents(*rows)))
    assert all(got[k].kept and got[k].clean_text == text and got[k].kept_words == got[k].n_words for k, text in rows)
    for phrase in quality_rules.BOILERPLATE:
        assert fault(f"({phrase.title()}.)") == fault(f"Here: {phrase} & {phrase}!") == "boilerplate"
    assert fault("Copyright 2020 Example Inc. All rights reserved.") == fault("Please click here to read more") == "boilerplate"
    assert fault("They spread more butter") == fault("A thread more") == fault("Design upwards") == ""


def test_rules_on_an_empty_table(documents):
    assert quality_rules.apply_rules(documents(*ODD).limit(0)).count() == 0


TRICKY = [prose(400, 1), "x" * 3000, "don't we'll I'm " * 90, "a  b   c\n\n\n d \t " * 70, "日本語テキスト" * 200, "12,345.6!? " * 120, "'" * 700, " " * 2000, "é ñ z" * 300, "🙂 ok " * 200]


@pytest.mark.parametrize("leaf", [16, 64, 512])
def test_tree_encodes_as_the_library(leaf):
    import base64

    import tiktoken

    path, pattern = tokenizer()
    ranks = bpe.read_ranks(path)
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    whole = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    codec = bpe.TreeCodec(ranks, pattern, leaf_chars=leaf, window_chars=8)
    for text in [*TRICKY, "".join(TRICKY), *["".join(RANDOM.choice(list(" \nab'st1.é"), 400)) for _ in range(20)]]:
        ids = codec.encode(text)
        assert ids == whole.encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_encode_rows(documents):
    got = bpe.encode(documents(*ODD, (4, "one")), *tokenizer()).collect()
    assert len(got) == len(ODD) + 1 and {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    assert all(len(r.ids) == 4 * r.n_tokens for r in got)


def spans_by_rule(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 14 <= len(d) <= 19 and sum(d[::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


PRIVATE = [
    "mail a.b@c.example.com_d@e.f and x@y", "🙂 1.2.3.4.5.6.7.8 999.1.1.1 010.0.0.255", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (389) 555-5010 4703443633947811", "+49 30 1234567 +4930", "a" * 3000 + "@b.c" + ".d" * 3000,
    "4111111111111111" * 3, "1.2.3.4" * 40, "IBAN DE89 3704 0044 0532 0130 00.", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "x" * 200_000 + " q@r.s",
]


def test_pii_spans_and_masks(documents):
    rows = [(100 + k, t) for k, t in enumerate(PRIVATE + ["".join(RANDOM.choice(list("a@.+ -(1234"), 300)) for _ in range(30)])]
    got = by_id(pii.find_pii(documents(*ODD, *rows)))
    for k, text in rows:
        assert [(s.start, s.kind_no, s.end) for s in got[k].spans if s.kind_no < pii.N_BASE] == spans_by_rule(text)
        assert all(0 <= s.start < s.end <= len(text) for s in got[k].spans)
    assert got[1].spans == got[2].spans == []
    assert [s.kind for s in got[108].spans] == ["iban"] and [s.kind for s in got[109].spans] == ["secret"]
    masked = by_id(pii.mask_pii(documents(*ODD, *rows)))
    assert masked[1].text is None and masked[2].text == "" and masked[4].size == "x"
    assert masked[102].text == "[CARD] and 4111-1111-1111-1112" and "[SECRET]" in masked[109].text
    for k, text in rows[:11]:
        assert not any(text[a:b] in masked[k].text for a, _, b in spans_by_rule(text))


def linked(texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    part = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]) and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = {k: low if v == high else v for k, v in part.items()}
    return {i: len(s) for i, s in sets.items()}, part


def near_copies(seed, n, edits):
    r, base = np.random.RandomState(seed), prose(120, seed).split()
    for _ in range(n):
        w = list(base)
        for at in r.randint(0, len(w), edits):
            w[at] = f"w{r.randint(1_000_000)}"
        yield " ".join(w[r.randint(0, 10) :])


@pytest.mark.parametrize("hot", [48, 6])
def test_ngram_join_finds_every_link(spark, documents, monkeypatch, hot):
    monkeypatch.setattr(ngram_join, "HOT_DOCS", hot)
    if hot < 48:
        monkeypatch.setattr(ngram_join, "GROUP", 8)
        monkeypatch.setattr(ngram_join, "LOCAL_GROUP", 6)
    passage = prose(90, 77)
    texts = [*near_copies(1, 25, 4), *near_copies(2, 25, 9), *[f"{passage} {prose(k + 5, 500 + k)}" for k in range(25)]]
    texts += [prose(n, 900 + n) for n in range(1, 30)] * 2 + ["a b c d", "A b C d", "a b c", "x y z w v", "x y z w v q"]
    rows = {100 + i: t for i, t in enumerate(texts)} | {i: t for i, t in ODD if i is not None}
    sizes, part = linked(rows)
    got = ngram_join.ngram_join(documents(*rows.items(), (None, passage), (None, passage))).collect()
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (sizes[r.doc_id], part[r.doc_id])
    assert sum(r.doc_id is None and r.component_id is None for r in got) == 2
    assert ngram_join.ngram_join(documents(*ODD).limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(200, 230)] + [(5, 5), (None, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {k: 100 for k in [100, *range(200, 230)]}


def repeats(texts):
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][j : j + 13]), i)
    out = {}
    for i, w in words.items():
        gone = {k for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < i for k in range(j, j + 13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), sha(kept), kept)
    return out


def test_substring_dedup(documents):
    p, q = prose(13, 1), prose(60, 2)
    texts = {50: q, 51: f"{prose(9, 3)} {q} {prose(4, 4)}", 52: p, 53: f"{p} {p}", 54: p.rsplit(" ", 1)[0], 55: "a " * 40, 56: "b " + "a " * 13, 57: "a b " * 30, 58: "b a " * 9}
    texts |= {60 + k: t for k, t in enumerate(near_copies(9, 12, 3))} | {i: t for i, t in ODD if i is not None}
    got = by_id(substring_dedup.remove_repeats(documents(*texts.items(), (None, q)), with_text=True))
    assert {i: tuple(got[i])[1:] for i in texts} == repeats(texts) and got[None].n_removed == 0
    assert substring_dedup.remove_repeats(documents(*ODD).limit(0)).count() == 0


def test_equal_windows_share_an_anchor():
    import pyarrow as pa

    seq = substring_dedup.Sequences(pa.array([" ".join(RANDOM.choice(list("aab"), 300)) for _ in range(4)]))
    starts = seq.window_starts(13)
    anchor, seen = substring_dedup.anchors(seq, starts), {}
    words = seq.words.to_pylist()
    for s, a in zip(starts.tolist(), anchor.tolist()):
        assert seen.setdefault(tuple(words[s : s + 13]), a) == a


def test_fit_subset_is_exact_when_it_can_be():
    for seed in range(20):
        r = np.random.RandomState(seed)
        counts = {int(s): int(c) for s, c in zip(r.randint(1, 60, 12), r.randint(1, 9, 12))}
        sums = {0}
        for s, c in counts.items():
            sums = {a + s * k for a in sums for k in range(c + 1)}
        budget = int(r.randint(0, max(sums) + 1))
        take = mixing.fit_subset(counts, budget, fit_words=40)
        got = sum(s * n for s, n in take.items())
        assert all(0 <= n <= counts[s] for s, n in take.items()) and budget - 60 <= got <= budget


def test_mix_meets_targets(documents):
    rows = [(i, prose(5 + i % 7, i), None if i % 11 == 0 else f"s{i % 4}") for i in range(300)] + [(900, None, "s0"), (901, "", None), (None, "a b", "s1"), (5, prose(10, 5), "s1")]
    got = mixing.mix_sources(documents(*rows)).collect()
    again = mixing.mix_sources(documents(*rows)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    total, took, target = Counter(), Counter(), {}
    for r in got:
        total[r.source] += r.size
        took[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    share = dict(zip(sorted(total, key=lambda s: (s is None, s or "")), [5, 2, 1, 5, 2]))
    assert abs(sum(target.values()) - sum(total.values())) < 1e-6
    for s in total:
        assert abs(took[s] - target[s]) <= 12 and target[s] <= 3 * total[s] and share[s]
    assert mixing.mix_sources(documents(*ODD).limit(0)).count() == 0


def test_chats_round_trip(spark):
    texts = ["plain", "", None, "\\### Assistant: </turn> ok", "a\\h#<\\", "### user: x</turn>\n### assistant: y", "####", "\\\\l\\</turn>"]
    rows = [(c, t, r, texts[(c + t) % len(texts)]) for c in range(12) for t, r in enumerate(["system", "user", "assistant", "a: b", "###", None])]
    rows += [(50, 1, "assistant", "tie"), (50, 1, "assistant", "tie"), (None, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnsRenamed({}).repartition(3)
    got = by_id(chat_format.format_chats(df), "conv_id")
    for c, row in got.items():
        own = sorted(((t is not None, t or 0, r or "", x or "") for k, t, r, x in rows if k == c))
        assert [(t.role, t.text) for t in row.turns] == [(r, x) for _, _, r, x in own]
        cut = [row.formatted[s.start : s.end] for s in row.loss]
        assert len(cut) == sum(r == "assistant" for _, _, r, _ in own)
        if not row.escaped:
            assert cut == [x for _, _, r, x in own if r == "assistant"]
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    r = np.random.RandomState(3)
    base = r.standard_normal((12, 24))
    vectors = np.concatenate([base[k % 12] + 0.12 * r.standard_normal(24) for k in range(150)]).reshape(150, 24)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(200 + k, [float(x) for x in base[0]]) for k in range(40)] + [(300, None), (301, [0.0] * 24), (302, [float("nan")] * 24), (303, [None] * 24), (304, []), (305, [1.0] * 3), (None, rows[0][1])]
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    got = by_id(near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), "vec_id")
    part, n = {i: i for i, _ in good}, Counter()
    for i, a in good:
        for j, b in good:
            if i < j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9:
                n[i], n[j] = n[i] + 1, n[j] + 1
                low, high = sorted((part[i], part[j]))
                part = {k: low if v == high else v for k, v in part.items()}
    found = sum(got[i].n_links for i, _ in good)
    assert all(got[i].n_links <= n[i] for i, _ in good) and found >= 0.97 * sum(n.values())
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (300, 301, 302, 303, 304, 305))
    assert all(got[200 + k].component_id == got[200].component_id for k in range(40))
    assert near_vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def labels_of(spark, rows, column):
    return spark.createDataFrame(rows, f"doc_id long, {column} int")


def test_quality_model_learns(spark, documents):
    rows = [(i, prose(60, i) if i % 3 else prose(60, i).replace(" ", "$$$ ").upper()) for i in range(240)]
    docs = documents(*rows, *ODD)
    model = quality_model.fit_quality(docs, labels_of(spark, [(i, int(i % 3 > 0)) for i in range(240)] + [(3, None), (None, 1)], "quality"))
    got = by_id(quality_model.score_quality(docs, model))
    assert np.mean([(got[i].score >= 0.7) == (i % 3 > 0) for i in range(100, 240)]) > 0.97 and 0 <= got[1].score <= 1
    blank = quality_model.fit_quality(docs, labels_of(spark, [], "quality"))
    assert {r.score for r in quality_model.score_quality(docs, blank).collect()} == {0.5}


def test_toxicity_learns(spark, documents):
    rows = [(i, prose(60, i) + (" you idiot and moron, fool!" if i % 4 == 0 else " fine.")) for i in range(300)]
    docs = documents(*rows, *ODD)
    model = toxicity.fit_toxicity(docs, labels_of(spark, [(i, int(i % 4 == 0)) for i in range(300)], "toxic"))
    got = by_id(toxicity.score_toxicity(docs, model))
    assert np.mean([(got[i].score >= 0.3) == (i % 4 == 0) for i in range(300)]) > 0.97
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_isotonic_rises():
    z, y = RANDOM.standard_normal(500), RANDOM.randint(0, 2, 500)
    out = boosting.fit_isotonic(z, y)(np.sort(z))
    assert (np.diff(out) >= 0).all() and 0 <= out.min() and out.max() <= 1


def test_loss_text_is_cut_at_the_spans(spark, monkeypatch, tmp_path):
    texts = ["plain", "", "\\### Assistant: </turn> ok", "a\\h#<\\", "🙂é ### 日本", "\\\\l\\</turn>\\c:"]
    rows = [(c, t, r, texts[(c + t) % len(texts)]) for c in range(6) for t, r in enumerate(["user", "assistant", "assistant", "a: b"])]
    rows += [(90, t, "user" if t % 3 else "assistant", f"x{t} é" * 9) for t in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat_format.format_chats(df)
    got = by_id(chats.withColumn("own", chat_format.loss_text(chats.formatted, chats.escaped, chats.loss)), "conv_id")
    assert {r.escaped for r in got.values()} == {True, False}
    for c, row in got.items():
        own = [x for k, _, r, x in rows if k == c and r == "assistant"]
        cut = [row.formatted[s.start : s.end] for s in row.loss]
        plain = [re.sub(r"\\(.)", lambda m: {"h": "#", "l": "<", "c": ":"}.get(m[1], m[1]), x) if row.escaped else x for x in cut]
        assert plain == own and row.own == "".join(own)

    from pyspark.sql import functions as F
    from pressmill.llm.queries import chat_query

    df.write.parquet(f"{tmp_path}/conversations.parquet")
    right, loss = by_id(chat_query(spark, str(tmp_path)), "conv_id"), chat_format._loss
    shifted = lambda *a: F.transform(loss(*a), lambda s: F.struct((s["start"] + 1).alias("start"), s["end"].alias("end")))
    monkeypatch.setattr(chat_format, "_loss", shifted)
    wrong = by_id(chat_query(spark, str(tmp_path)), "conv_id")
    assert right[90].loss_sha256 == sha(got[90].own) and wrong[90].loss_sha256 != right[90].loss_sha256


def test_substitutes_at_the_edge_of_a_word_count():
    at = {name: k for k, name in enumerate(toxicity.FEATURES)}
    for text in ("you are $tupid", "ein 7rottel", "tu eres 1diota hoy", "i hat3 it", "so st*pid of an 1d1ota"):
        x = toxicity.features(text, {})
        assert x[at["obfuscated_rate"]] > 0 and (x[at["hidden_insults"]] > 0 or "*" in text)
    for text in ("on the 20th of 100 at 5pm, 1st!", "fine words!! $5 10km (good)", "idiot!", "mp3 in 1984"):
        x = toxicity.features(text, {})
        assert x[at["obfuscated_rate"]] == x[at["hidden_insults"]] == 0


def test_sample_has_one_row_for_each_id(spark, documents):
    from pressmill.llm import labelled

    docs = documents(*[(1, prose(9, 1))] * 500, *[(i, prose(9, i)) for i in range(2, 40)], (5, prose(9, 5)), (6, None), (40, None))
    labels = [(1, 1)] * 300 + [(i, i % 2) for i in range(2, 41)] + [(7, 0), (7, 0), (8, 1)]
    got = labelled.training_texts(docs, labels_of(spark, labels, "quality"), "quality").collect()
    held = {r.doc_id for r in docs.where(labelled.held_out(docs.doc_id)).collect()}
    assert sorted(r.doc_id for r in got) == sorted(set(range(1, 41)) - held)
    assert all(r.y == (0 if r.doc_id == 7 else r.doc_id % 2) and r.text == (None if r.doc_id == 40 else prose(9, r.doc_id)) for r in got)
    few = labelled.training_texts(docs, labels_of(spark, labels, "quality"), "quality", rows=5)
    assert few.count() == 5


def test_blobs_go_to_as_many_buckets_as_entries():
    x = np.arange(4000)
    to = ngram_join._blob(1000, 1, x, x, x, size=1).column("bucket").to_pylist()
    assert min(to) >= 0 and max(to) < 1000 and len(set(to)) > 900 and max(Counter(to).values()) < 25


def test_a_family_of_near_copies_gives_an_edge_a_set_not_a_pair(spark, documents, monkeypatch):
    """Edges that reach the components grow with the sets of a family, not with its pairs."""
    edges, plain = [], ngram_join.components
    monkeypatch.setattr(ngram_join, "components", lambda e: edges.append(e.count()) or plain(e))
    texts = list(near_copies(3, 40, 1))
    got = ngram_join.ngram_join(documents(*enumerate(texts))).collect()
    _, part = linked(dict(enumerate(texts)))
    assert {r.doc_id: r.component_id for r in got} == part
    assert edges and max(edges) <= 2 * len(texts)


def test_groups_drop_pivots_that_met_all_and_close_without_light_sets_left(spark):
    # Groups 1 and 2 have 40 light members each and 3 others, group 3 has 5 light members.
    rows = [(k, s, 1 if s < 40 else 0, 40, s) for k in (1, 2) for s in range(43)] + [(3, s, 1, 5, s) for s in range(5)]
    placed = spark.createDataFrame(rows, "key bigint, sid bigint, light int, lights bigint, part bigint")
    met = {(r.key, r.sid) for r in placed.where(ngram_join._chosen(16)).collect()}
    left = {(r.key, r.sid) for r in ngram_join._unmet(placed, 16).collect()}
    assert {(3, s) for s in range(5)} <= met and 0 < len([k for k, _ in met if k == 1]) < 40
    assert left == {(k, s) for k, s, *_ in rows if k < 3} - met
    assert not ngram_join._unmet(placed, 256).count() and not placed.where(ngram_join._chosen(0)).count()


def test_sets_that_share_entries_of_large_groups_still_do_without_those_they_can_spare(spark):
    r = np.random.RandomState(5)
    common, rows, sets = [np.unique(r.randint(0, 1 << 63, 60).astype(np.uint64)) for _ in range(4)], [], []
    for i in range(24):
        own = r.randint(0, 1 << 63, 40).astype(np.uint64) if i % 4 == 0 else sets[i - 1][r.rand(len(sets[i - 1])) > 0.04]
        sets.append(np.unique(np.concatenate([own, *([common[j] for j in r.permutation(4)[: i % 3]] if i % 4 == 0 else [])])))
    hot = np.sort(np.concatenate(common))
    for sid, features in enumerate(sets):
        keys, flags, (band, *_) = ngram_join.signatures(features, hot)
        rows += [(sid, int(k), *[int(f & x) for x in (1, 4, 8, 16)], *ngram_join._spare(keys, flags, band)) for k, f in zip(keys.astype(np.int64), flags)]
    big = spark.createDataFrame(rows, "sid bigint, key bigint, own int, light int, full int, single int, spare bigint, spare_next bigint")
    kept = {(x.sid, x.key) for x in ngram_join._needed(big).collect()}
    assert len(kept) < 0.9 * len(rows)
    mine = [{k for s, k, *_ in rows if s == i} for i in range(24)]
    left = [{k for s, k in kept if s == i} for i in range(24)]
    pairs = [(a, b) for a in range(24) for b in range(a) if 4 * len(np.intersect1d(sets[a], sets[b])) >= 3 * len(np.union1d(sets[a], sets[b]))]
    assert len(pairs) > 20 and all(mine[a] & mine[b] and left[a] & left[b] for a, b in pairs)


def test_members_of_large_groups_meet_in_tiles_and_only_near_ones_become_rows(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    r = np.random.RandomState(6)
    names = ["key", *ngram_join._MEMBER, "lights", "members"]
    rows = []
    for key, n in ((1, 30), (2, 3), (3, 11)):
        for i in range(n):
            cells = [int(np.array(r.randint(0, 3, 8) + 60 * (w == 0), np.uint8).view(np.int64)[0]) for w in range(4)]
            rows.append((key, 100 * key + i, int(r.randint(0, 3)), int(r.randint(0, 2)), int(r.choice([0, 8])), int(r.randint(0, 20)), int(r.randint(80, 120)), *cells, n, n))
    members = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c in ('own', 'full') else 'bigint'}" for c in names))
    bytes_ = lambda x: np.array(x[7:11], np.int64).view(np.uint8).astype(int)
    want = set()
    for x in rows:
        for y in (p for p in rows if p[1] % 2 and p[0] == x[0]):
            differ = int(np.abs(bytes_(x) - bytes_(y)).sum()) + (x[5] + y[5] if x[4] else 0)
            if x[2] != y[2] and x[3] + y[3] and 4 * min(x[6], y[6]) >= 3 * max(x[6], y[6]) and 7 * differ <= x[6] + y[6]:
                want.add((min(x[1], y[1]), max(x[1], y[1])))
    got = [tuple(x) for x in ngram_join._met(members, members.where("sid % 2 = 1"), 16).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 10 < len(want) < 500
