import math
import random
import re

from rollcall.llm.license_scan import MISS, TEMPLATES, _index, _shingles, digest, scan, scan_text


def corpus():
    r = random.Random(12)
    every = [t for texts in TEMPLATES.values() for t in texts]
    words = lambda n: " ".join(f"w{r.randrange(300)}" for _ in range(n))
    out = [None, "", " ", "MIT License", "Released under the MIT", "x" * 100_000, words(30_000)]
    out += [f"{words(r.randint(0, 200))}\n{t}\né {words(r.randint(0, 50))}" for t in every]
    out += ["/*\n * " + "\n * ".join(every[2].split(" and ")) + "\n */", every[3].upper().replace(",", " ,"), " ".join([every[0]] * 3)]
    for _ in range(60):
        own = r.choice(every).split()
        for _ in range(r.choice([0, 1, 2, 5])):
            own[r.randrange(len(own))] = "changed"
        out.append(f"{words(r.randint(0, 300))} {' '.join(own)} {words(r.randint(0, 300))} {r.choice(every)}")
    r.shuffle(out)
    return out


def test_equals_verification_of_all_pairs(spark):
    own = corpus()
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(own)], "doc_id long, text string, matches int").repartition(3)
    got = {r.doc_id: [tuple(m) for m in r.matches] for r in scan(docs).collect()}
    for i, t in enumerate(own):
        assert got[i] == scan_text(t or "", _index()), (i, t)


def naive(text, name):
    """Whether a run of at most L five-word shingles holds 75 % of those of a template of the license; by sets of tuples."""
    plain = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    own = grams(plain(text))
    for template in TEMPLATES[name]:
        t = set(grams(plain(template)))
        size = 1 << (len(t) - 1).bit_length()
        need = math.ceil(0.75 * len(t))
        at = [i for i, g in enumerate(own) if g in t]
        if any(len({own[j] for j in at if i <= j < i + size}) >= need for i in at):
            return True
    return False


def test_equals_naive_search_over_all_windows(spark):
    own = [t for t in corpus() if t is None or len(t) < 20_000]
    docs = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    got = {r.doc_id: {m.license for m in r.matches} for r in scan(docs).collect()}
    for i, t in enumerate(own):
        assert got[i] == {name for name in TEMPLATES if naive(t or "", name)}, t


def test_identifier_lines_and_whole_texts():
    named = lambda t: [(m[0], m[3]) for m in scan_text(t, _index())]
    assert named("// SPDX-License-Identifier: GPL-2.0-only\nint x;") == [("GPL-2.0", 100)]
    assert named("# SPDX-License-Identifier: Apache-2.0") == [("Apache-2.0", 100)]
    whole = TEMPLATES["MIT"][-1]
    assert named(f"Copyright someone\n{whole}\nend") == [("MIT", 100)]


def test_every_template_is_found_where_it_is():
    for name, texts in TEMPLATES.items():
        for t in texts:
            found = scan_text(f"some words before it. {t} And some after", _index())
            assert any(m[0] == name and m[1] == 22 and m[2] >= 22 + len(t.rstrip('.:,)"')) - 1 and m[3] == 100 for m in found), (name, t, found)


def test_bands_miss_seldom():
    for t in _index().templates:
        j = t.need / (2 * t.size + len(t.shingles) - t.need)
        assert (1 - j) ** t.bands <= MISS


def test_digest(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License. Then words. Licensed under CC BY-NC 4.0."), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, digest(docs).collect())) == [(1, 2, "CC-BY-NC-4.0,MIT", "MIT:0:30,CC-BY-NC-4.0:44:71"), (2, 0, "", "")]
    assert digest(docs.limit(0)).collect() == []


def test_a_lone_cut_notice_is_retrieved():
    index = _index()
    assert index.retrieve(_shingles("")[1]) == set()
    for i, text in enumerate(t for texts in TEMPLATES.values() for t in texts):
        cut = _shingles(text)[1][: index.templates[i].need]
        assert i in {found for _, _, found in index.retrieve(cut)}, (text, len(cut))


def test_clashing_columns_and_repeated_rows(spark):
    row = (1, "Released under the MIT License.", "x", 5, 6)
    docs = spark.createDataFrame([row, row, (None, "none", "x", 5, 6)], "doc_id long, text string, licenses string, n_matches int, matches int")
    assert sorted((r[0] or 0, r[1]) for r in digest(docs).collect()) == [(0, 0), (1, 1), (1, 1)]
