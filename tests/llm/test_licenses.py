import random
from itertools import combinations

from starbrook.llm import licenses as L

SF = "/root/testdata/sf0.001"


def longest_increasing(places):
    for n in range(len(places), 0, -1):
        for chosen in combinations(places, n):
            if all(a < b for a, b in zip(chosen, chosen[1:], strict=False)):
                return n
    return 0


def test_increasing_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        places = rng.sample(range(30), rng.randint(0, 9))
        chain = [places[i] for i in L.increasing(places)]
        assert chain == sorted(set(chain)) and len(chain) == longest_increasing(places)


def test_alignment_is_a_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 14))]
        b = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 14))]
        pairs = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    text = L.words_of(L.LICENSES[4][2])
    assert len(L.align(text, text)) == len(text)


def test_notices(rows, documents):
    notices = {"licensed under cc by-nc 4.0": "CC-BY-NC-4.0", "gnu general public license, version 3": "GPL-3.0",
               "under the apache license, version 2.0": "Apache-2.0", "released under the mit license": "MIT",
               "all rights reserved": "All-Rights-Reserved"}
    want = {i: next((n for x, n in notices.items() if x in t.lower()), None) for i, t in rows}
    assert {r.doc_id: r.license for r in L.scan(documents).collect()} == want


def test_changed_license_texts(spark):
    rng = random.Random(3)
    noise = [f"noise{i}" for i in range(50)]
    mit = L.LICENSES[4][2].split()
    some = list(mit)
    for k in rng.sample(range(10, len(mit)), 12):
        some[k] = rng.choice(noise)
    most = [w if rng.random() < 0.5 else rng.choice(noise) for w in mit]
    before = [rng.choice(noise) for _ in range(500)]
    rows = [(1, " ".join(before + mit + before)), (2, " ".join(before + some + before)), (3, " ".join(before + most)),
            (4, " ".join(before)), (5, " ".join(mit[::-1])), (6, "Released under the BSD License."),
            (7, " ".join(before + mit) + "\nLicensed under the Apache License, Version 2.0.")]
    found = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    words = len(L.words_of(" ".join(mit)))
    assert found[1].license == "MIT" and found[1].coverage == 1.0
    assert (found[1].first_word, found[1].last_word) == (500, 500 + words - 1)
    assert found[2].license == "MIT" and abs(found[2].coverage - (words - 12) / words) < 0.03
    assert all(found[i].license is None for i in (3, 4, 5, 6))
    assert found[7].licenses == "Apache-2.0,MIT"


def test_notices_with_inserted_words_at_every_offset():
    noise = [f"noise{i}" for i in range(400)]
    short = "Licensed under the terms of the Apache Software License, Version 2.0"
    lines = L.LICENSES[4][2].split()
    long = " ".join(w if k % 9 else f"{w} dnl br" for k, w in enumerate(lines))
    for notice, name in ((short, "Apache-2.0"), (long, "MIT")):
        scanner, size = L.Scanner(L.LICENSES), len(L.words_of(notice))
        for k in range(2 * size):
            found = scanner.scan(" ".join([*noise[:k], notice, *noise[k:]]))
            assert [(f.name, f.coverage) for f in found] == [(name, 1.0)], k
            assert found[0].first == k and found[0].last - k in (size - 1, size - 2, size - 3), k


def test_siblings_are_told_apart():
    scanner = L.Scanner(L.LICENSES)
    names = {
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
        "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
        "All rights reserved.": "All-Rights-Reserved",
    }
    names |= {text: name for name, _, text in L.LICENSES}
    for text, name in names.items():
        assert [f.name for f in scanner.scan(f"some words {text} and more")] == [name], text
    both = "Licensed under CC BY-NC 4.0. " + "filler " * 30 + "Licensed under CC BY 4.0. All rights reserved."
    assert [f.name for f in scanner.scan(both)] == ["CC-BY-NC-4.0", "CC-BY-4.0", "All-Rights-Reserved"]


def exhaustive(scanner, text):
    """Names with coverage, from the alignment of every window of a text."""
    words, best = L.words_of(text), {}
    for t in scanner.templates:
        size = len(t.words)
        for start in range(len(words)):
            pairs = L.align(words[start : start + 2 * size], t.words)
            if not pairs or len(pairs) / size < t.least or not t.required <= {t.words[j] for _, j in pairs}:
                continue
            if t.foreign.isdisjoint(words[start + pairs[0][0] : start + pairs[-1][0] + 1]):
                best[t.name] = max(best.get(t.name, 0.0), len(pairs) / size)
    return best


def test_scan_equals_all_windows():
    rng = random.Random(5)
    scanner = L.Scanner(L.LICENSES)
    noise = ["the", "license", "under", "gnu", "cc", "nc", "version", "3", "x", "y", "z"]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 3)):
            notice = L.words_of(rng.choice([x for x in L.LICENSES if len(x[2]) < 260])[2])
            parts += [w for w in notice if rng.random() < 0.95] + rng.choices(noise, k=rng.randint(0, 8))
            if rng.random() < 0.5:
                parts.insert(rng.randrange(len(parts) + 1), rng.choice(noise))
        text = " ".join(parts)
        found = {}
        for f in scanner.scan(text):
            found[f.name] = max(found.get(f.name, 0.0), f.coverage)
        assert found == exhaustive(scanner, text), text


def test_odd_rows(odd, none):
    found = L.scan(odd).collect()
    assert len(found) == odd.count() and {r.license for r in found} == {None}
    assert L.scan(none).collect() == []
