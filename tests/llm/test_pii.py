import hashlib
import random
import re

from pairrank.llm import pii as P

from .conftest import pairs_of

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def base(text):
    out = []
    for kind, expression in PLAIN.items():
        for m in re.finditer(expression, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def check(docs):
    want = sorted((d, hashlib.sha256(",".join(b := base(t)).encode()).hexdigest(),
                   *[sum(s.startswith(k) for s in b) for k in PLAIN]) for d, t in pairs_of(docs) if d is not None)
    rows = P.find_personal_data(docs).collect()
    assert sorted((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows if r.doc_id is not None) == want
    assert len(rows) == docs.count()
    return rows


def test_edge_cases(edge_docs, no_docs):
    check(edge_docs)
    assert P.find_personal_data(no_docs).count() == 0


def test_hard_texts(spark):
    rnd = random.Random(5)
    bits = ["a", "b@", "@", "x.y", "1", "22", "255", "256", ".", "-", " ", "+1 ", "(", "4111 1111 1111 1111", "4111111111111111",
            "+49 30 1234567", "a@b.c%d@e.f", "1.2.3.4", "1.2.3.4.5", "é🙂", "\n", "%", "_", "99"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(25))) for _ in range(300)]
    texts += ["1" * 20_000, "a" * 50_000 + "@" + "b" * 1000, "+1" + "(" * 20_000, "1 " * 2000, "x 10.0.0.1 " * 300]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_contexts_discover_unseen_identifiers(spark):
    """Numbers without a plus sign after words that precede phone numbers; the same shape elsewhere stays."""
    rows = [(k, f"please call me at +1 (743) 555-{3800 + k} after noon") for k in range(12)]
    rows += [(100, "please call me at 743 555 9999 after noon"), (101, "the part 743 555 1111 was sold"),
             (102, "then 743 555 9999 again")]
    rows += [(200 + k, f"the part 743 555 {2000 + k} was sold") for k in range(8)]
    rows += [(300 + k, f"mail to u{k}@host.example now") for k in range(6)]
    rows += [(400, "mail to some.one (at) host [dot] example now")]
    got = {r.doc_id: r for r in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got[100].spans == "phone:18:30" and got[102].spans == "phone:5:17" and got[400].spans.startswith("email:8:")
    assert got[101].spans == "" and all(got[200 + k].spans == "" for k in range(8))
    assert all(got[k].n_added == 0 and got[k].spans for k in range(12))


def test_discovered_values_support_new_contexts(spark):
    """Numbers found beside seeds reveal a context without seeds, and that one a further number."""
    rows = [(k, f"please call me at +1 (743) 555-{3800 + k} after noon") for k in range(60)]
    for k in range(10):
        rows += [(100 + k, f"please call me at 743 555 {9100 + k} after noon"),
                 (200 + k, f"our fax line is 743 555 {9100 + k} since may")]
    rows += [(300, "our fax line is 743 555 8888 since may"), (301, "then 743 555 8888 again")]
    got = {r.doc_id: r.n_added for r in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert all(got[d + k] == 1 for d in (100, 200) for k in range(10))
    assert got[300] == 1 and got[301] == 1


def test_no_python_in_the_plan(spark, edge_docs):
    df = edge_docs.select(P.base_spans(edge_docs["text"]).alias("a"), P.mentions(edge_docs["text"]).alias("b"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
