import re

from wellmart.llm import licenses as lic


def words_of(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    w = words_of(text)
    return len(w), sorted((i, label) for p, label in lic.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


def test_phrases(docs, edge):
    texts = ["Under the MIT License; under-the mit LICENSE", "cc by nc cc by nc by cc by", "apache license version 2 apache license version 22",
             "under the mit under the mit license version 2"]
    for t in texts:
        f = lic.LicenseScanner().scan(t.encode())
        assert (f["n_words"], sorted(f["places"])) == brute(t)
    for df in (docs, edge):
        text = df.collect()
        got = lic.license_digest(df).collect()
        want = []
        for r in text:
            n, places = brute(r["text"])
            want.append((str(r["doc_id"]), n, len(places), *((min(places)[0], max(places)[0]) if places else (None, None)),
                         ",".join(sorted({x for _, x in places}))))
        assert sorted(map(str, want)) == sorted(str((str(r["doc_id"]), *r[1:6])) for r in got)


def test_templates_chain_over_changes():
    s = lic.LicenseScanner()
    for label, t in lic.TEMPLATES.items():
        got = [c for c in s.scan(f"Some text. {t.upper()} more".encode())["chains"] if c[0] == label]
        assert max(c[3] for c in got) == 1.0 and got[0][1:3] == (2, 2 + len(t.split()))
    w = lic.TEMPLATES["mit"].split()
    broken = " ".join(w[:12] + ["inserted", "words"] + w[12:25] + w[26:])
    best = max((c for c in s.scan(broken.encode())["chains"] if c[0] == "mit"), key=lambda c: c[3])
    assert 0.9 < best[3] < 1.0 and best[1:3] == (0, len(broken.split()))
    assert s.scan(" ".join(w[:6]).encode())["chains"] == []


def test_matching_statistics_are_longest():
    seqs = [[1, 2, 3, 4, 1, 2], [2, 3, 5], [4, 1, 2, 3, 5, 5]]
    a = lic.SuffixAutomaton(seqs)
    text = [1, 2, 3, 5, 5, 4, 1, 2, 9, 2, 3, 4]
    inside = lambda p: any(s[i:i + len(p)] == p for s in seqs for i in range(len(s)))
    for i, (s, n) in enumerate(a.stream(text)):
        best = max((k for k in range(i + 2) if not k or inside(text[i + 1 - k:i + 1])), default=0)
        assert n == best
        if n:
            p = text[i + 1 - n:i + 1]
            assert a.ends[s] == sorted((k, j + n) for k, q in enumerate(seqs) for j in range(len(q)) if q[j:j + n] == p)


def test_empty(empty):
    assert lic.license_digest(empty).count() == 0
