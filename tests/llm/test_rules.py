"""Quality rules, language, mixing and chat against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from corpus import ODD, documents, prose
from pyspark.sql import functions as F

from tickertone.llm import chat, language, mixing, quality


def plain_quality(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    lines = [x for x in text.split("\n") if x.encode().split()]
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    n, repeated = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            repeated, n < 50 or 100 * repeated > 50 * n)


def test_quality_counts_and_common_lines(spark):
    common = "Licensed under terms 12.\nALL rights   reserved 7"
    texts = [f"{prose(i, 60)}\n{common.lower() if i % 2 else common}" for i in range(30)]
    texts += [common + "\n" + prose(i, 60) for i in (50, 51)]
    texts += ["a b c " * 30, "x\ny\nx\n x\n\n", "# <b> $1 | é%", prose(1, 60), *ODD]
    texts.append("\n".join([common] * 9 + [prose(3, 12)]))
    sources = ["hot"] * 30 + ["other"] * (len(texts) - 31) + ["hot"]
    rows = documents(spark, texts, source=sources)
    got = {r.doc_id: r for r in quality.quality(rows, min_docs=10, share=0.2).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_quality(text)
        assert r.kept <= (not r.base_failed)
    assert all(got[i].n_common_words == 8 and got[i].kept for i in range(30))
    assert got[30].n_common_words == 0 and got[30].kept  # not common in its own host
    depleted = got[len(texts) - 1]
    assert depleted.n_common_words == 72 and not depleted.kept


def test_quality_depletes_without_a_base_failure(spark):
    lines = [f"boiler {'ab'[i % 2]}{i} plate{i} text{i} of{i} words{i}" for i in range(12)]
    texts = ["\n".join(lines) + f"\n{prose(i, 5)}" for i in range(15)] + [prose(i, 60) for i in range(20, 30)]
    got = {r.doc_id: r for r in quality.quality(documents(spark, texts), min_docs=5, share=0.1).collect()}
    assert all(not got[i].kept and not got[i].base_failed for i in range(15))
    assert all(got[i].kept for i in range(15, 25))


def test_quality_odd_rows(odd, nothing):
    got = quality.quality(odd).collect()
    assert len(got) == len(ODD) + 3 and quality.quality(nothing).count() == 0
    assert [r.n_words for r in got if r.doc_id is None] == [0]


def plain_language(texts, labels, wanted, size):
    """Profiles and predictions with dictionaries."""
    def grams(text):
        word, out = [], Counter()
        for c in [*text.lower(), " "]:
            if c.isalpha():
                word.append(c)
            elif word:
                padded = ["", *word, ""]
                for n in (1, 2, 3):
                    for i in range(len(padded) - n + 1):
                        g = tuple(padded[i:i + n])
                        if (n == 1 and g[0]) or n == 2 or (n == 3 and g[1]):
                            out[g] += 1
                word = []
        return out

    def code(g):
        s = [0 if c == "" else 1 + ord(c) % 1021 for c in g]
        if len(s) == 3:
            return s[0] << 20 | s[1] << 10 | s[2]
        return 1 << 30 | (s[0] << 10 | s[1] if len(s) == 2 else 1 << 20 | s[0])

    def ranks(counted):
        merged = Counter()
        for g, n in counted.items():
            merged[code(g)] += n
        return {g: i for i, (g, _) in enumerate(sorted(merged.items(), key=lambda x: (-x[1], x[0]))[:size])}

    total = defaultdict(Counter)
    for t, y in zip(texts, labels, strict=True):
        total[y] += grams(t)
    profiles = {y: ranks(c) for y, c in total.items()}
    out = []
    for t in wanted:
        own = ranks(grams(t))
        if not own:
            out.append(("und", 0.0))
            continue
        distance = {y: sum(abs(p[g] - r) if g in p else size for g, r in own.items()) for y, p in profiles.items()}
        best = min(sorted(distance), key=distance.get)
        out.append((best, 1 - distance[best] / (len(own) * size)))
    return out


def test_language_is_that_of_the_profiles(spark):
    r = random.Random(2)
    sound = {"aa": "banana lama kasa", "bb": "ström über größe", "cc": "église naïve çà"}
    texts, labels = [], []
    for y, words in sound.items():
        for _ in range(25):
            texts.append(" ".join("".join(r.sample(words, r.randrange(2, 7))) for _ in range(20)))
            labels.append(y)
    wanted = texts + ["", "12 3", "é", "Banana-LAMA!", "ström " * 50]
    docs = documents(spark, texts + wanted[75:], lang=labels + [None] * 5)
    got = sorted(language.identify(docs).collect(), key=lambda x: x.doc_id)
    train = [i for i in range(75) if not got[i].held_out]
    plain = plain_language([texts[i] for i in train], [labels[i] for i in train], wanted, language.PROFILE)
    for x, (y, score) in zip(got, plain, strict=True):
        assert x.lang_pred == y and x.score == pytest.approx(score)
    assert {x.held_out for x in got} == {True, False}


def test_language_odd_rows(odd, nothing):
    got = {r.doc_id: r for r in language.identify(odd).collect()}
    assert got[None].lang_pred == "und" and got[1].lang_pred == "und" and not got[None].held_out
    assert all(r.score == 0 for r in got.values() if r.lang_pred == "und")
    assert language.identify(nothing).count() == 0
    kept = language.with_language(odd, language.learn(odd), out="__x", score="__y")
    assert kept.columns == [*odd.columns, "__x", "__y"] and kept.count() == odd.count()


def plain_budgets(leaves, weights, budget, epochs):
    """Tokens per leaf, from the top of the tree down, child by child."""
    def deal(nodes, level, given):
        children = defaultdict(list)
        for path, tokens in nodes:
            children[path[level]].append((path, tokens))
        caps = {k: sum(t for _, t in v) * epochs for k, v in children.items()}
        w = {k: weights.get(mixing.LEVELS[level], {}).get(k, 1.0) for k in children}
        open_, out, left = {k for k in children if caps[k] and w[k]}, {}, given
        while open_:
            full = {k for k in open_ if caps[k] <= w[k] * left / sum(w[j] for j in open_) + 1e-9}
            if not full:
                total = sum(w[j] for j in open_)
                out |= {k: min(caps[k], int(w[k] * left / total + 1e-6)) for k in open_}
                break
            out |= {k: caps[k] for k in full}
            left -= sum(caps[k] for k in full)
            open_ -= full
        if level == len(mixing.LEVELS) - 1:
            return {children[k][0][0]: n for k, n in out.items()}
        return {p: n for k, given_ in out.items() for p, n in deal(children[k], level + 1, given_).items()}

    return deal(list(leaves.items()), 0, budget)


@pytest.mark.parametrize("share, epochs, stretch", [(0.5, 2, 1024), (0.9, 1, 4), (3.0, 2, 4), (1.4, 3, 1024)])
def test_mixing_reaches_its_budgets(spark, monkeypatch, share, epochs, stretch):
    monkeypatch.setattr(mixing, "STRETCH_DOCS", stretch)
    r = random.Random(7)
    texts = [prose(i, r.choice([0, 1, 5, 40, 300])) for i in range(240)]
    sources = [r.choice(["s0", "s0", "s0", "s1", "s2", "s6", "odd", None]) for _ in texts]
    langs = [r.choice(["en", "en", "de", None]) for _ in texts]
    mix = mixing.Mix({"domain": {"d0": 5.0, "d1": 0.0}, "lang": {"en": 2.0}}, share, epochs, 3)
    docs = documents(spark, texts, source=sources, lang=langs)
    got = mixing.select(docs, mixing.plan(docs, mix), mix, "taken").collect()
    domain = {"s0": "d0", "s1": "d1", "s2": "d2", "s6": "d2"}
    leaves, docs_of = Counter(), defaultdict(list)
    for i, (t, s, y) in enumerate(zip(texts, sources, langs, strict=True)):
        leaf = (domain.get(s, ""), y or "", s or "")
        leaves[leaf] += len(t.split())
        docs_of[leaf].append(i)
    budget = min(int(sum(leaves.values()) * share + 1e-9), sum(leaves.values()) * epochs)
    wanted = {k: n for k, n in plain_budgets(leaves, mix.weights, budget, epochs).items() if n}
    assert {(x.taken.domain, x.taken.lang, x.taken.source): x.taken.budget for x in got if x.taken.budget} == {
        k: n for k, n in wanted.items()}
    copies = {x.doc_id: x.taken.copies for x in got}
    for leaf, n in wanted.items():
        sizes = {i: len(texts[i].split()) for i in docs_of[leaf]}
        assert max(copies.get(i, 0) for i in sizes) - min(copies.get(i, 0) for i in sizes) <= 1
        taken = sum(copies.get(i, 0) * k for i, k in sizes.items())
        assert n <= taken < n + max(sizes.values()) + (n % leaves[leaf] == 0)
    out = mixing.mixture(docs, mix)
    assert out.columns == docs.columns
    assert Counter(x.doc_id for x in out.collect()) == Counter(copies)


def water(leaves, weights, budget, epochs):
    """Budgets by raising a level until the children of a node have what it has, top down, with
    fractions; ``leaves`` maps paths to tokens."""
    def weight(path):
        return weights.get(mixing.LEVELS[len(path) - 1], {}).get(path[-1], 1.0)

    def cap(path):
        if not all(weight(path[:i + 1]) for i in range(len(path))):
            return 0
        if len(path) == len(mixing.LEVELS):
            return leaves[path] * epochs
        return sum(cap(c) for c in {p[:len(path) + 1] for p in leaves if p[:len(path)] == path})

    def fill(path, given):
        if len(path) == len(mixing.LEVELS):
            return {path: given}
        children = sorted({p[:len(path) + 1] for p in leaves if p[:len(path)] == path})
        low, high = 0.0, 1e12
        for _ in range(200):
            level = (low + high) / 2
            low, high = (level, high) if sum(min(cap(c), weight(c) * level) for c in children) < given else (low, level)
        out = {}
        for c in children:
            out |= fill(c, min(cap(c), weight(c) * high))
        return out

    return fill((), min(budget, cap(())))


@pytest.mark.parametrize("own, epochs, share, given", [(1600, 1, 0.5, 2000), (1000, 1, 0.9, 3000), (2000, 2, 0.5, 2000), (0, 1, 1.0, 4000)])
def test_mixing_gives_the_budget_that_leaves_can_take(spark, own, epochs, share, given):
    """Source s0 of domain d0 must give nothing; its tokens are no capacity of the domain."""
    tokens = {"s0": own, "s4": 2000 - own, "s1": 1000, "s5": 1000}
    texts = ["w " * (n // 20) for n in tokens.values() for _ in range(20)]
    sources = [s for s in tokens for _ in range(20)]
    mix = mixing.Mix({"source": {"s0": 0.0}, "domain": {"d0": 3.0}}, share, epochs, 1)
    docs = documents(spark, texts, source=sources)
    planned = {(r.domain, r.lang, r.source): r.budget for r in mixing.plan(docs, mix).collect()}
    domains = {"s0": "d0", "s4": "d0", "s1": "d1", "s5": "d1"}
    leaves = {(domains[s], "en", s): n for s, n in tokens.items()}
    wanted = water(leaves, mix.weights, int(4000 * share), epochs)
    assert sum(planned.values()) == given and ("d0", "en", "s0") not in planned
    assert all(abs(planned.get(k, 0) - n) <= 1 for k, n in wanted.items())


@pytest.mark.parametrize("seed", range(4))
def test_mixing_against_water_filling(spark, seed):
    r = random.Random(seed)
    names = [f"s{i}" for i in range(9)]
    sources = [r.choice(names) for _ in range(200)]
    langs = [r.choice(["en", "de", "fr"]) for _ in sources]
    texts = ["w " * r.choice([0, 5, 40, 200]) for _ in sources]
    weights = {
        "domain": {f"d{i}": r.choice([0.0, 1.0, 4.0]) for i in range(3)},
        "lang": {"en": 5.0, "de": r.choice([0.0, 1.0])}, "source": {s: r.choice([0.0, 1.0, 2.5]) for s in names},
    }
    mix = mixing.Mix(weights, r.choice([0.3, 0.8, 2.0]), r.choice([1, 3]), seed)
    leaves = Counter()
    for t, s, y in zip(texts, sources, langs, strict=True):
        leaves[f"d{int(s[1:]) % 4}", y, s] += len(t.split())
    planned = {(x.domain, x.lang, x.source): x.budget for x in mixing.plan(documents(spark, texts, source=sources, lang=langs), mix).collect()}
    budget = int(sum(leaves.values()) * mix.share + 1e-9)
    for leaf, n in water(leaves, weights, budget, mix.max_epochs).items():
        assert abs(planned.get(leaf, 0) - n) <= 4, leaf  # a token is lost to rounding at each level


def test_mixing_odd_rows(odd, nothing):
    mix = mixing.Mix()
    assert mixing.mixture(odd, mix).columns == odd.columns and mixing.mixture(nothing, mix).count() == 0


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def spans(text, mask):
    return [text[int(a):int(b)] for a, b in (x.split(":") for x in mask.split(",") if x)]


def test_chat_pairs(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "éa"), (1, 2, "user", "more"), (1, 3, "assistant", "last"), (1, 4, "user", "bye"),
            (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (3, 0, "user", "alone"), (4, 0, "system", "s"), (4, 1, "assistant", "one")]
    got = {(r.kind, r.chosen_id, r.rejected_id): r for r in chat.format_preferences(turns(spark, rows * 2)).collect()}
    assert set(got) == {("stale", 1, 1), ("stale", 2, 2), ("stale", 4, 4), ("opening", 1, 2)}
    stale = got["stale", 1, 1]
    assert stale.n_prompt_turns == 3 and stale.prompt.endswith("<|user|>\nmore<|end|>\n")
    assert stale.chosen == "<|assistant|>\nlast<|end|>\n" and stale.rejected == "<|assistant|>\néa<|end|>\n"
    assert spans(stale.chosen, stale.chosen_mask) == ["last<|end|>"]
    assert spans(got["stale", 2, 2].rejected, got["stale", 2, 2].rejected_mask) == ["hi<|end|>"]
    opening = got["opening", 1, 2]
    assert opening.prompt == "<|user|>\nhi<|end|>\n" and opening.n_prompt_turns == 1
    assert spans(opening.chosen, opening.chosen_mask) == ["éa<|end|>", "last<|end|>"]
    assert spans(opening.rejected, opening.rejected_mask) == ["other<|end|>"]


def test_chat_long_conversations_come_in_pieces(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(50)]
    got = sorted(chat.format_preferences(turns(spark, rows), piece_turns=8).collect(), key=lambda r: r.piece)
    assert [r.piece for r in got] == list(range(7)) and sum(r.n_prompt_turns for r in got) == 49
    assert "".join(r.prompt + r.chosen for r in got) == "".join(f"<|{r[2]}|>\n{r[3]}<|end|>\n" for r in rows)


def test_chat_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "assistant", None), (1, 0, "assistant", "b"), (2, 5, "assistant", "")]
    got = {r.chosen_id: r for r in chat.format_preferences(
        turns(spark, rows).withColumns({"side": F.lit(1), "kind": F.lit(2)})).collect()}
    assert set(got) == {1, 2} and got[1].prompt == "<|unknown|>\n<|end|>\n"
    assert got[2].chosen == "" and got[2].n_prompt_turns == 1  # both sides are the same
    assert chat.format_preferences(turns(spark, [])).count() == 0


def syllables(seed, sounds, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(sounds) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_texts_unlike_every_language_are_told_apart(spark):
    """Random letters and the sounds of no learned language score below the learned bound, clean texts above."""
    sounds = {"one": ["the", "an", "ing", "er", "st", "ou"], "two": ["der", "sch", "ung", "ein", "ge", "ch"],
              "three": ["que", "les", "eau", "oi", "ment", "ai"]}
    r = random.Random(9)
    rows = [(syllables(i, s, r.choice([4, 15, 60, 400])), y) for i in range(150) for y, s in sounds.items()]
    docs = documents(spark, [t for t, _ in rows], lang=[y if i % 5 else None for i, (_, y) in enumerate(rows)])
    profiles = language.learn(docs)
    least = language.least_score(docs, profiles)
    scored = language.with_language(docs, profiles).collect()
    assert 0.1 < least <= min(x.score for x in scored)
    letters = "abcdefghijklmnopqrstuvwxyz"
    odd = ["".join(r.choice(letters + " ") for _ in range(n)) for n in (30, 300, 3000, 30000)]
    odd += [syllables(5, ["kku", "aa", "ylly", "vo", "jo"], n) for n in (10, 100, 1000)]
    assert all(s < least for s in profiles.predict(odd)[1])
    assert language.least_score(docs.where("lang IS NULL"), profiles) == 0.0


def test_language_learns_from_every_labelled_document(spark):
    """More of one language than any bound: the one text that scores least counts, wherever it is."""
    rows = spark.range(14_000).selectExpr("id AS doc_id", "'banana lama' AS text", "'aa' AS lang")
    kept = rows.where(~language.held_out(F.col("doc_id")))
    assert language.labelled(rows).count() == kept.count() > 10_000
    profiles = language.learn(rows)
    for odd in [r.doc_id for r in kept.orderBy("doc_id").limit(8).collect()]:
        text = F.when(F.col("doc_id") == odd, "bananx lamq").otherwise(F.col("text"))
        least = language.least_score(rows.withColumn("text", text), profiles, margin=1.0)
        assert least == pytest.approx(profiles.predict(["bananx lamq"])[1][0]) and least < 0.99
