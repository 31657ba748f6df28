"""Document operators against brute force, on awkward rows and on nothing."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
import tiktoken

from acoustic_spark.llm import bpe, credentials, exact_dedup, jaccard, language, mixing, repeats
from acoustic_spark.llm.queries import RANKS


def collected(df):
    return [r.asDict() for r in df.collect()]


def test_exact_copies(awkward, nothing):
    out = collected(exact_dedup.mark_copies(awkward))
    assert len(out) == 14
    by_text = defaultdict(list)
    for r in out:
        by_text[re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")].append(r)
    for group in by_text.values():
        assert sum(r["kept"] for r in group) == 1
        assert {r["group_size"] for r in group} == {len(group)}
        ids = [r["doc_id"] for r in group if r["doc_id"] is not None]
        assert {r["keep_id"] for r in group} == {min(ids, default=None)}
    assert exact_dedup.mark_copies(nothing).count() == 0


def ranges(text, pattern, least, group=0):
    return [(m.start(), m.end()) for m in regex.finditer(pattern, text) if len(m[group]) >= least]


def test_secrets(docs, nothing):
    shared, own = "AKIA" + "A1" * 8, "0123456789abcdef0123"
    texts = [f"é𝛼 key {shared} and Token:  '{own}'.", f"{shared} secret=short password=token:abcdefghijklmnop", f"x {shared}", None, "Bare Zz9Zz9Zz9Zz9Zz9Zz9Zz9 end"]
    out = collected(credentials.scan(docs([(i, t, None, f"s{i}") for i, t in enumerate(texts)])))
    for r in out:
        text = texts[r["doc_id"]] or ""
        found = [(s.start, s.end) for s in r["base_spans"]]
        assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        assert sorted(found) == sorted(ranges(text, assign, 12, 2) + ranges(text, r"AKIA[A-Z0-9]+", 18) + ranges(text, "[0-9a-f]+", 16))
        live = {text[s.start : s.end] for s in r["all_spans"] if s.kind == "live"}
        assert live == {0: {own}, 4: {"Zz9Zz9Zz9Zz9Zz9Zz9Zz9"}}.get(r["doc_id"], set())
    assert credentials.scan(nothing).count() == 0


def test_secrets_of_any_length_and_without_digits(docs):
    own, copied = "Ab1/" * 75, "Cd2+" * 100
    texts = [f"session {own} end", f"see {copied} here", f"and {copied}", "password = CorrectHorseBattery", "password = ExampleExample", "secret: ExampleExample", "NoDigitsInThisBareTokenAtAll"]
    live = {}
    for r in collected(credentials.scan(docs([(i, t, None, f"s{i}") for i, t in enumerate(texts)]))):
        live[r["doc_id"]] = {texts[r["doc_id"]][s.start : s.end] for s in r["all_spans"] if s.kind == "live"}, r["n_shared"]
    assert live == {0: ({own}, 0), 1: (set(), 1), 2: (set(), 1), 3: ({"CorrectHorseBattery"}, 0), 4: (set(), 1), 5: (set(), 1), 6: (set(), 0)}


def test_secrets_awkward(awkward):
    assert credentials.scan(awkward).count() == 14


def brute_sets(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)]) if w else frozenset())
    return sets


def brute_components(ids, sets):
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = {}
    for i in range(len(sets)):
        out[i] = min(ids[j] for j in range(len(sets)) if find(j) == find(i))
    return out


def test_near_copies(docs, nothing):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 6, 7, 9, 40, 150, 400]))]
        for _ in range(rng.randint(1, 9)):
            changed = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            texts.append(" ".join(changed))
    texts += [None, "", "A b", "a B"]
    found = collected(jaccard.join_similar(docs([(i, t, None, None) for i, t in enumerate(texts)])))
    sets = brute_sets(texts)
    expected = brute_components(list(range(len(texts))), sets)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in found} == {i: len(s) for i, s in enumerate(sets)}
    assert jaccard.join_similar(nothing).count() == 0


@pytest.mark.parametrize("levels", [0, 7, 15, None])
def test_signatures_meet(levels):
    """Similar sets share a signature whatever the classes of their tokens."""
    rng = np.random.default_rng(5)
    level_of = lambda x: (x >> np.uint64(50)).astype(np.uint8) % 20 if levels is None else np.full(len(x), levels, np.uint8)
    for _ in range(300):
        n = int(rng.integers(6, 200))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.06], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 14))).astype(np.uint64)]))
        if jaccard.similar(a, b):
            assert len(np.intersect1d(jaccard.signatures(a, level_of(a)), jaccard.signatures(b, level_of(b))))
            assert jaccard.may_be_similar(jaccard.bitmap(a)[None], np.array([len(a)]), jaccard.bitmap(b)[None], np.array([len(b)]))[0]


def test_stars_across_batches():
    signature = np.repeat([1, 2, 3, 4, 5], [1, 2, 3, 7, 2])
    frame = pd.DataFrame({"signature": signature, "number": np.arange(len(signature))})
    for size in (1, 2, 3, 5, 100):
        out = pd.concat(jaccard._stars(iter([frame[i : i + size] for i in range(0, len(frame), size)])))
        pairs = {(a, b) for a, b in zip(out["a"], out["b"]) if b >= 0}
        first = frame.groupby("signature")["number"].transform("min")
        assert pairs == {(a, b) for a, b in zip(first, frame["number"]) if a != b}
        many = sorted((s, a) for s, a, b in zip(out["signature"], out["a"], out["b"]) if b < 0)
        assert many == sorted((s, n) for s, n in zip(frame["signature"], frame["number"]) if s in (3, 4))


def test_near_copies_awkward(awkward):
    out = collected(jaccard.join_similar(awkward))
    assert len(out) == 14
    assert {r["component_id"] for r in out if r["doc_id"] in (5, 6)} == {5}


def brute_repeats(rows, length=repeats.LENGTH):
    seen, out = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        covered = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                covered[i : i + length] = True
            seen.add(window)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        runs = int((np.diff(np.append(0, covered.astype(int))) == 1).sum())
        out[key] = (len(data), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats(docs, nothing):
    rng = random.Random(2)
    words = ["the", "of", "é", "𝛼", "aa", "bb", "ab"] + [f"w{i}" for i in range(40)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 90))) for _ in range(6)]
    texts = [" ".join(rng.choice(passages) if rng.random() < 0.3 else rng.choice(words) for _ in range(40)) for _ in range(30)]
    texts += ["a" * 500, "ab" * 300, "a" * 99, "a" * 100, None, "", texts[0], "x" + texts[1] + "y"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["starts"]), r["kept_sha256"]) for r in collected(repeats.remove_repeats(docs([(i, t, None, None) for i, t in rows])))}
    assert found == brute_repeats(sorted(rows))
    assert repeats.remove_repeats(nothing).count() == 0


def test_repeats_awkward(awkward, docs):
    out = collected(repeats.remove_repeats(awkward))
    assert len(out) == 14
    same = collected(repeats.remove_repeats(docs([(1, "abc " * 20 + "z", None, None)] * 2)))
    assert [r["n_removed"] for r in same] == [0, 0]  # a repeated row is one text


@pytest.mark.parametrize("least", [0, -5, -(1 << 63)])
def test_repeats_of_many_texts_without_id(docs, least):
    """Each text holds a passage of its own twice; none is taken for another."""
    n = 4_000 if least > -(1 << 63) else 1
    passages = ["".join(random.Random(i).choices("abcdefghij ", k=120)) for i in range(n)]
    rows = [(None, p + "|" + p, None, None) for p in passages] + [(None, passages[0] + "|" + passages[0], None, None), (least, passages[-1], None, None), (7, "x", None, None)]
    out = collected(repeats.remove_repeats(docs(rows)))
    assert sorted(r["n_removed"] for r in out if r["doc_id"] is None) == [120] * (n + 1)
    assert {r["doc_id"]: r["n_removed"] for r in out if r["doc_id"] is not None} == {least: 120, 7: 0}


@pytest.mark.parametrize("least", [7, 6, -(1 << 40)])
def test_repeats_of_many_texts_of_one_id(docs, least):
    """Thousands of texts share one id: none is taken for another, other ids keep their order, texts without an id come first."""
    passages = ["".join(random.Random(i).choices("abcdefghij ", k=120)) for i in range(4_000)]
    others = [(least - 1, passages[0]), (8, passages[1]), (None, passages[2]), (9, passages[3]), (9, passages[3])]
    rows = [(7, p + "|" + p, None, None) for p in passages] + [(7, passages[9] + "|" + passages[9], None, None)] + [(i, t, None, None) for i, t in others]
    out = collected(repeats.remove_repeats(docs(rows)))
    # The text that holds what an earlier row has loses both of its copies.
    assert sorted(r["n_removed"] for r in out if r["doc_id"] == 7) == [120] * (len(passages) - 1) + [240] * 2
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in out if r["doc_id"] != 7) == sorted([(str(least - 1), 0), ("8", 120), ("None", 0), ("9", 120), ("9", 120)])


def test_repeats_long_text_in_pieces(monkeypatch):
    """A text that is cut into pieces gives the windows of the whole."""
    monkeypatch.setattr(repeats, "CHUNK", 250)
    data = "".join(random.Random(1).choice("abc") for _ in range(1200))
    pieces = list(repeats._segments(iter([pd.DataFrame({"doc": [1], "mark": [0], "text": [data]})])))
    windows = [base + i for _, _, base, part in pieces for i in range(len(part) - repeats.LENGTH + 1)]
    assert windows == list(range(len(data) - repeats.LENGTH + 1))


def test_pass_across_batches():
    """Decided and open rows do not depend on how rows come in batches."""
    rng = np.random.default_rng(1)
    n = 400
    frame = pd.DataFrame({"kind": 1, "key": rng.integers(0, 60, n), "whole": rng.integers(0, 3, n), "doc": rng.integers(0, 9, n), "place": rng.integers(0, 50, n)})
    frame = frame.sort_values(["key", "whole", "doc", "place"], ignore_index=True)
    results = set()
    for size in (1, 3, 50, n):
        state, decided, open_ = repeats._Pass(list(frame)), [], []
        for i in range(0, n, size):
            d, o = state.batch(frame[i : i + size])
            decided += d[["key", "doc", "place"]].values.tolist()
            open_ += o[["key", "whole", "doc", "place"]].values.tolist()
        results.add(str((sorted(decided), sorted(open_))))
    assert len(results) == 1


def test_mix(docs, awkward, nothing):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 40))), None, rng.choice(["a", "b", "c", "é", None])) for i in range(400)]
    out = collected(mixing.mix(docs(rows)))
    size = Counter()
    for _, text, _, source in rows:
        size[source] += len(text.split())
    taken = Counter()
    for r in out:
        assert r["size"] == len(r["text"].split()) and 0 <= r["times"] <= 2 and r["source_size"] == size[r["source"]]
        taken[r["source"]] += r["times"] * r["size"]
    targets = {r["source"]: r["target"] for r in out}
    assert abs(sum(targets.values()) - 1.5 * sum(size.values())) < 1e-6
    assert all(t <= 2 * size[s] + 1e-9 for s, t in targets.items())
    assert all(abs(taken[s] - t) <= 1 for s, t in targets.items())
    again = collected(mixing.mix(docs(rows)))
    assert {r["doc_id"]: r["times"] for r in out} == {r["doc_id"]: r["times"] for r in again}
    assert mixing.emit(mixing.mix(docs(rows))).count() == sum(r["times"] for r in out)
    assert mixing.mix(awkward).count() == 14 and mixing.mix(nothing).count() == 0


def test_fit_budget_is_best():
    rng = random.Random(6)
    for _ in range(60):
        counts = [(length, rng.randint(1, 3)) for length in rng.sample(range(1, 12), 4)]
        reach = {0}
        for length, n in counts:
            reach = {r + length * k for r in reach for k in range(n + 1)}
        budget = rng.randint(0, sum(a * b for a, b in counts))
        taken = mixing.fit_budget(counts, budget)
        assert all(0 <= t <= n for t, (_, n) in zip(taken, counts))
        assert sum(t * length for t, (length, _) in zip(taken, counts)) <= budget
        assert budget - sum(t * length for t, (length, _) in zip(taken, counts)) <= max(length for length, _ in counts)


@pytest.fixture(scope="module")
def vocabulary():
    data = open(public_tokenizers.path(RANKS), "rb").read()
    ranks = bpe.parse_ranks(data)
    return bpe.Bpe(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_like_the_library(vocabulary):
    own, library = vocabulary
    assert bpe.USUAL == public_tokenizers.PATTERN
    rng = random.Random(1)
    pool = [chr(c) for c in [*range(0x500), 0x1680, *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x1F600, 0x10FFFF]]
    texts = ["".join(rng.choice(pool if rng.random() < 0.5 else " \t\n'stabre0123 \x1c\x85\xa0") for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    texts += ["".join(rng.choice("aabb"[:k]) for _ in range(rng.randint(0, 80))) for _ in range(500) for k in (2, 4)]
    texts += ["a" * 30_000, "ab" * 9_000, "x" * (bpe.LONG_TEXT + 5), "".join(rng.choice("theaniongr") for _ in range(20_000))]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text)
        assert own.decode(ids.tolist()) == text.encode()
    assert regex.findall(r"\s+", "a \x1c b") and len(list(own.encode([]))) == 0


def test_bpe_documents(awkward, nothing):
    path = public_tokenizers.path(RANKS)
    out = collected(bpe.encode_documents(awkward, path, public_tokenizers.PATTERN))
    assert len(out) == 14 and all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in out)
    assert bpe.encode_documents(nothing, path, public_tokenizers.PATTERN).count() == 0


def test_language(spark, awkward, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify_all(docs).toPandas()
    held = out[out["held_out"]]
    assert len(held) > 100 and (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert out["score"].between(0, 1).all()
    rows = collected(language.identify_all(awkward))
    assert len(rows) == 14
    assert {r["lang_pred"] for r in rows if not (r["text"] or "").strip()} == {"und"}
    assert language.identify_all(nothing).count() == 0


def brute_language(train, text):
    """Scores by the counts of all words and n-grams of (text, lang) rows."""
    word, gram = defaultdict(Counter), defaultdict(Counter)
    for t, lang in train:
        for w in language.words(t):
            word[lang][w] += 1
            gram[lang].update(g for order in language.ORDERS for g in language.grams(w, order))
    langs, scores = sorted(word), {}
    for name, counts in (("word", word), ("gram", gram)):
        size = len(set().union(*counts.values()))
        scores[name] = lambda x, counts=counts, size=size: np.array([np.log((counts[a][x] + 0.5) / (counts[a].total() + 0.5 * size)) for a in langs])
    total = np.zeros(len(langs))
    for w in language.words(text):
        if any(word[a][w] for a in langs):
            total += scores["word"](w)
            continue
        for order in language.ORDERS:
            known = [g for g in language.grams(w, order) if any(gram[a][g] for a in langs)]
            if known:
                total += np.mean([scores["gram"](g) for g in known], axis=0)
                break
    share = np.exp(total - total.max())
    return langs[int(np.argmax(total))], float(share.max() / share.sum())


def test_language_keeps_all_counts(docs, monkeypatch):
    """Results are those of the whole statistics, however few words and n-grams go to every task."""
    rng = random.Random(9)
    stems = {a: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(60)] for a, letters in (("xa", "abcdef"), ("xb", "bcdefg"), ("xc", "cdefgh"))}
    rows = [(i, " ".join(rng.choice(stems[a]) + rng.choice(["", "e", "dd"]) for _ in range(rng.randint(1, 6))), a) for i, a in enumerate(rng.choices(sorted(stems), k=120))]
    rows += [(1000 + i, t, None) for i, t in enumerate(["zzz", "abba zzz", "a", rows[0][1], rows[0][1], "", "1 2"])]
    data = docs([(i, t, a, None) for i, t, a in rows])
    train = [(t, a) for i, t, a in rows if a and zlib.crc32(str(i).encode()) % 5]
    for most in (60_000, 5):
        monkeypatch.setattr(language, "HOT_WORDS", most)
        monkeypatch.setattr(language, "HOT_GRAMS", most)
        out = {r["doc_id"]: r for r in collected(language.identify_all(data))}
        assert len(out) == len(rows)
        for i, t, _ in rows:
            expected = brute_language(train, t) if language.words(t) else ("und", 0.0)
            assert (out[i]["lang_pred"], pytest.approx(out[i]["score"], abs=1e-9)) == expected


def test_numbers_are_no_letters(docs):
    assert language.words("Straße² ½ ①Ⅷ x²y 𝛼1b") == ["straße", "x", "y", "𝛼", "b"]
    rows = [(i, t, lang, None) for i, (t, lang) in enumerate([("the cat", "en"), ("der Hund", "de"), ("² ½", "en"), ("Ⅷ", "de"), ("① 7", None)] * 4)]
    out = collected(language.identify_all(docs(rows)))
    assert {r["lang_pred"] for r in out if r["doc_id"] % 5 > 1} == {"und"} and {r["score"] for r in out if r["doc_id"] % 5 > 1} == {0.0}
