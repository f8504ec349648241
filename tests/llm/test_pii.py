import hashlib
import random
import re
import time

from cases import SF01, edge_documents, empty_documents

from shoplens.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [list(EMAIL.finditer(text)), [m for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))],
             [m for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
             [m for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]]
    spelled = ",".join(f"{k}:{m.start()}:{m.end()}" for k, own in zip(pii.KINDS, found) for m in own)
    return tuple(map(len, found)), spelled


def same(row, text):
    counts, spelled = brute(text or "")
    return (counts == (row.n_email, row.n_ip, row.n_card, row.n_phone) and row.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
            and row.spans.startswith(spelled) and (row.n_found > 0 or row.spans == spelled))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.find_personal_data(docs).collect()
    assert len(rows) == len(texts) and all(same(r, texts[r.doc_id]) for r in rows)


def test_odd_texts(spark):
    rnd = random.Random(3)
    parts = list("a1.@+-% 25()é\n") + ["1.2.3.4", "+1 234", "4111 1111 1111 1111", "x@y.z", " 0 ", "00256.1.1.1", "\U0001f600"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(40))) for _ in range(1500)]
    texts += ["1" * 3000, "a" * 30000, "1 " * 5000, "a@b" * 1000, "+1" * 2000, None, "", "a@b.c+d@e.f", "4111-1111-1111-1111", "a@b.c.", "1.2.3.4.5"]
    rows = pii.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)).collect()
    assert all(same(r, texts[r.doc_id]) for r in rows)


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"some words then reachme: user{i}@example.com and more words") for i in range(20)]
    rows += [(100, "again reachme: user-at-example-77x2 here"), (101, "version 4.0.1 of the words"), (102, "note user-at-example-77x2 again")]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    text = rows[20][1]
    s = text.index("user-at")
    assert got[100].spans == f"id:{s}:{s + len('user-at-example-77x2')}"
    assert got[102].n_found == 1 and got[101].n_found == 0


TOKEN = re.compile(r"(?<!\S)(?:[+(]?[0-9][0-9().+-]*(?: [0-9(][0-9().-]*)+[.,;:!?]*(?!\S)|[^\s0-9@]*[0-9@]\S*)")


def brute_found(texts):
    """The method in plain Python: added (row, start, end) from patterns, instances and rounds."""
    cands, totals = [], {}
    for t, text in enumerate(texts):
        base = [m.span() for m in EMAIL.finditer(text)]
        base += [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
        base += [m.span() for m in CARD.finditer(text) if 13 <= len(re.sub("[^0-9]", "", m.group())) <= 19 and luhn(re.sub("[^0-9]", "", m.group()))]
        base += [m.span() for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
        hit = {i for a, b in base for i in range(a, b) if text[i] in "0123456789@"}
        found = list(TOKEN.finditer(text))
        for k, m in enumerate(found):
            before = text[found[k - 1].end() if k else 0:m.start()].lower()
            after = text[m.end():found[k + 1].start() if k + 1 < len(found) else len(text)].lower()
            head = re.match(r"""(?:[A-Za-z_][A-Za-z_-]*[:=])?["'(<\[]*""", m.group()).group()
            name = re.match(r"(?:[A-Za-z_][A-Za-z_-]*[:=])?", head).group().lower()
            core = m.group()[len(head):].rstrip("\"')>],.;:!?")
            if len(core) < 4 or not re.search("[0-9].*[0-9]|@", core):
                continue
            left = before.split() if before[-1:].isspace() else []
            l1, l2 = (left[-1] if left else ""), (left[-2] if len(left) > 1 else "")
            right = after.split()[0] if after[:1].isspace() and after.split() and m.group()[-1] not in "\"')>],.;:!?" else ""
            shape = re.sub("[A-Za-z]+", "a", re.sub("[0-9]+", "9", core))
            pats = {p for ok, p in ((name, f"n {name}"), (l1, f"l {l1}"), (l1 and l2, f"ll {l2} {l1}"), (right, f"r {right}"),
                                    (l1 and right, f"lr {l1} {right}"), (l1, f"ls {l1} {shape}")) if ok}
            s = m.start() + len(head)
            cands.append((t, s, s + len(core), core, any(i in hit for i in range(*m.span())), pats))
        w = text.lower().split()
        for i, x in enumerate(w):
            own = [f"l {x}", f"r {x}"] + ([f"ll {w[i - 1]} {x}"] if i else []) + ([f"lr {x} {w[i + 2]}"] if i + 2 < len(w) else [])
            for p in own:
                totals[p] = totals.get(p, 0) + 1
    edges, seed = {}, {}
    for _, _, _, core, is_seed, pats in cands:
        for p in pats:
            edges.setdefault(p, {}).setdefault(core, 0)
            edges[p][core] += 1
            seed[core] = seed.get(core, False) or is_seed
    for p in edges:
        if p.startswith("ls "):
            totals[p] = sum(edges["l " + p.split(" ")[1]].values())
    weight = {i: float(v) for i, v in seed.items()}
    for _ in range(pii.ROUNDS):
        sure = {}
        for p, own in edges.items():
            conf = sum(n * weight[i] for i, n in own.items()) / max(totals.get(p, 0), sum(own.values()))
            if sum(weight[i] >= pii.MIN_WEIGHT for i in own) >= pii.MIN_SUPPORT and conf >= pii.MIN_CONFIDENCE:
                sure[p] = conf
        new = {}
        for i in weight:
            doubt = 1.0
            for p, own in edges.items():
                if i in own and p in sure:
                    doubt *= max(1e-9, 1 - sure[p])
            new[i] = max(float(seed[i]), 1 - doubt)
        weight = new
    good = {i for i, w in weight.items() if w >= pii.MIN_WEIGHT and not seed[i]}
    return {(t, s, e) for t, s, e, core, is_seed, _ in cands if core in good and not is_seed}


def found_spans(rows):
    return {(r.doc_id, int(x.split(":")[1]), int(x.split(":")[2])) for r in rows for x in r.spans.split(",") if x.startswith("id:")}


def test_added_spans_against_brute_force(spark):
    rnd = random.Random(8)
    filler = ["the", "of", "note", "v1.2", "and", "2024", "item", "x9-77", "12 34", "call"]
    cue = [("mail to", "b{n}@mail.org", "ab-{n}-zz9"), ("server at", "10.0.{n}.1", "node{n}0x7"), ("my card", "4111 1111 1111 1111", "9999 {n}0 1234 77"),
           ("user=", "u{n}@d.net", "q{n}w77"), ("reach", "+1 (555) 010-99{n}", "ext-{n}99")]
    texts = []
    for _ in range(250):
        parts = rnd.choices(filler, k=rnd.randrange(3, 14))
        for _ in range(rnd.randrange(0, 3)):
            lead, good, bad = rnd.choice(cue)
            what = (good if rnd.random() < 0.8 else bad).format(n=rnd.randrange(10, 60))
            parts.insert(rnd.randrange(len(parts) + 1), lead + ("" if lead.endswith("=") else " ") + what + rnd.choice(["", "", ",", ".", " now"]))
        texts.append(rnd.choice([" ", "  ", "\n"]).join(parts))
    rows = pii.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)).collect()
    expect = brute_found(texts)
    assert found_spans(rows) == expect and len(expect) > 10
    assert all(same(r, texts[r.doc_id]) for r in rows)


def test_several_contexts_and_no_false_ones(spark):
    rows = [(i, f"the old words before my login {i}a@mail.org and then text number {i} of many") for i in range(12)]
    rows += [(20 + i, f"other words 10.0.0.{i} answered the call of {i} people in 19{i:02d}") for i in range(12)]
    rows += [(40 + i, f"so account=u{i}@shop.net was used {i} times since 2019") for i in range(12)]
    hidden = [(100, "again my login qx-77-12 here", "qx-77-12"), (101, "words xk.90.zz answered at last", "xk.90.zz"), (102, "so account=zz90-11 was used", "zz90-11")]
    rows += [(i, t) for i, t, _ in hidden]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, t, value in hidden:
        assert got[i].spans == f"id:{t.index(value)}:{t.index(value) + len(value)}", (i, got[i].spans)
    assert all(got[i].n_found == 0 for i, _ in rows if i < 100)


def test_a_long_left_word_is_a_pattern_whole(spark):
    cue = "c" * 200
    rows = [(i, f"see {cue}: u{i}@mail.org now") for i in range(8)] + [(50, f"see {cue}: zz-90-11 now"), (51, f"see {cue[:60]}: zz-90-12 then")]
    got = {r.doc_id: r.n_found for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[50] == 1 and got[51] == 0


def test_many_matches_in_one_text_take_linear_time(spark):
    ips = " ".join(f"10.{i % 256}.{i // 256 % 256}.7" for i in range(100_000))
    df = spark.createDataFrame([(1, ips + " \ue000\ue0015 a\ue0001@x.y")], "doc_id bigint, text string")
    t = time.time()
    (row,) = pii.find_personal_data(df).collect()
    assert time.time() - t < 60
    assert row.n_ip == 100_000 and row.n_email == 1
    spans = row.spans.split(",")
    assert spans[-1].startswith("ip:") and spans[-1].split(":")[1] == str(ips.rindex(" ") + 1)


def test_defined_cases(spark):
    docs = edge_documents(spark)
    rows = pii.find_personal_data(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[10].n_email, by[10].n_ip, by[10].n_card, by[10].n_phone) == (1, 1, 1, 1)
    assert by[4].spans == "" and by[7].n_email == 1
    assert pii.find_personal_data(empty_documents(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = pii.find_personal_data(edge_documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
