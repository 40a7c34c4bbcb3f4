import collections
import random

from pyspark.sql import functions as F

from boardlake.llm import decontaminate, quality, urls

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.net", "/en/private"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
         ("block", "a.org", "/fr/x"), ("allow", "", "/never"), ("block", "dup.net", "/"), ("allow", "dup.net", "/"), (None, "x.org", None)]


def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for v, h, p in RULES:
        if h is None or p is None or not host:
            continue
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h + p), len(h), v)
            if best is None or key > best[0]:
                best = (key, h + p, v)
    return host, path, best and best[1], best[2] if best else "allow"


def test_url_verdicts(spark):
    rng = random.Random(6)
    hosts = ["example.net", "m.example.net", "notexample.net", "EXAMPLE.com", "a.b.org", "a.org", "net", "", "x", "dup.net", "q.dup.net", "exämple.net", "m..net", "h:80"]
    paths = ["", "/", "/en/", "/en/private/1", "/en", "/fr/x?y", "/de/#z", "/fr/ü", "?q=/en/", "#/fr/"]
    made = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    made += [None, "", "no scheme", "://", "http:/x.net/", "a://b://c.net/", "x\ny://m.net/a\nb"] + made[:5]
    df = spark.createDataFrame([(i % 200 if i % 17 else None, u) for i, u in enumerate(made)], "page_id long, url string").selectExpr("*", "1 as host", "2 as at", "3 as path")
    got = collections.Counter(tuple(r) for r in urls.url_verdicts(df, urls.rule_table(spark, RULES)).collect())
    want = collections.Counter((i % 200 if i % 17 else None, *plain_verdict(u)) for i, u in enumerate(made))
    assert got == want


def test_urls_without_rules_or_rows(spark):
    rules = urls.rule_table(spark, RULES)
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in urls.url_verdicts(pages, rules.where("false")).collect()] == [(1, "a.net", "/", None, "allow")]
    assert urls.url_verdicts(pages.where("false"), rules).count() == 0


def plain_base(text):
    text = text or ""
    words = text.encode().split()
    words = [w.decode() for w in words]
    tri = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(tri)
    covered = {i + j for i, t in enumerate(tri) if often[t] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_quality_base_measures(docs, docs_rows):
    got = quality.quality(docs)
    found = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got.collect())
    assert found == collections.Counter((i, *plain_base(t)) for i, t in docs_rows)


def test_quality_line_rules(spark, empty):
    prose = " ".join(f"word{i} and{i} thing{i}." for i in range(30))
    nav = " | ".join(f"link{i}" for i in range(60))
    loud = " ".join(f"BUY{i}!!" for i in range(60))
    bare = " ".join(f"tag{i}" for i in range(60))
    legal = "All rights reserved. " + " ".join(f"x{i}" for i in range(60)) + "."
    texts = {1: prose, 2: nav + ".", 3: loud, 4: bare, 5: legal, 6: prose + "\n" + "Home | About | News.", 7: prose + "\n\n \n" + nav, 8: None, 9: "short."}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in quality.quality(df).collect()}
    assert [got[i].kept for i in range(1, 10)] == [True, False, False, False, False, True, got[7].lost_chars <= 0.4 * got[7].word_chars, False, False]
    assert got[6].cleaned == prose and got[6].n_bad_lines == 1
    assert got[7].n_lines == 2
    assert quality.quality(empty).count() == 0


def plain_pairs(docs, items, width=5, threshold=0.8):
    out = []
    for d, text in docs:
        for i, item in items:
            w = min(len(decontaminate._words(item)), width)
            if w:
                a, b = decontaminate.shingles(item, w), decontaminate.shingles(text, w)
                if len(a & b) >= threshold * len(a) - 1e-9:
                    out.append((d, i, len(a), len(a & b)))
    return collections.Counter(out)


def test_contamination_by_brute_force(spark, docs, docs_rows, monkeypatch, empty):
    rng = random.Random(1)
    items = []
    for k in range(40):
        words = decontaminate._words(rng.choice(docs_rows)[1])
        if len(words) > 8:
            a = rng.randint(0, len(words) - 6)
            own = [w.decode() for w in words[a : a + rng.randint(3, 40)]]
            if k % 3 == 0:
                own[rng.randrange(len(own))] = "zzz"
            items.append((k, ("; " if k % 2 else " ").join(own).replace("a", "A").replace("é", "É")))
    items += [(50, None), (51, ""), (52, "?!"), (None, "a b c"), items[0]]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as id", "2 as k1", "3 as i1")
    want = plain_pairs(docs_rows, items)
    assert len(want) > 20
    for spare, common, bits in ((4, 32, 1 << 25), (0, 0, 1 << 7)):
        monkeypatch.setattr(decontaminate, "SPARE", spare)
        monkeypatch.setattr(decontaminate, "COMMON", common)
        monkeypatch.setattr(decontaminate, "MOST_BITS", bits)
        got = collections.Counter((r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in decontaminate.contaminated(docs, table).collect())
        assert got == want
    clean = sum(not plain_pairs([row], items) for row in docs_rows)
    for rows in (1 << 19, 0):  # keys of bad texts go to all tasks, or meet the texts in a shuffle
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
        kept = decontaminate.decontaminate(docs, table)
        assert kept.columns == docs.columns and kept.count() == clean
    assert decontaminate.decontaminate(docs, table.where("false")).count() == docs.count()
    for kind in ("int", "string", "decimal(9,2)"):  # ids of any type
        typed = decontaminate.contaminated(docs.withColumn("doc_id", F.col("doc_id").cast(kind)), table.withColumn("item_id", F.col("item_id").cast(kind)))
        assert {t for c, t in typed.dtypes if c in ("doc_id", "item_id")} == {kind}
        assert typed.count() == want.total()
    assert decontaminate.contaminated(docs, table.where("false")).count() == 0
    assert decontaminate.contaminated(empty, table).count() == 0
