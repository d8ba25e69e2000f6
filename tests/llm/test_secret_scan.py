import hashlib
import re
from collections import Counter

from emberline.llm import secret_scan as secrets

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)


def base_spans(text):
    found = [("assign", m) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    kinds = ["assign", "access", "hex"]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in sorted(found, key=lambda f: (f[1].start(), kinds.index(f[0])))]


TEXTS = [
    None, "", "plain words only", "Password: hunter22 and TOKEN = 'abc' then api_key=\"abcdef\"", "secret=short",
    "é𝄞 apikey:=abcdef99 AKIA" + "A" * 16 + " AKIAshort", "0123456789abcdef01234567 x" + "f" * 23 + " " + "e" * 24,
    "token=" + "a" * 30, "ſecret=abcdefgh pasKword", "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20,
    "x token==abcde token =  \"abcdefg", "passwd'  :  'qwerty1' secret\n=abcdefgh",
    "y " * 40_000 + "password=abcdefg " + "z" * 1000 + " AKIA" + "Q" * 20,
]


def test_base_spans_match_brute_force(make):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[3]), (None, None)]
    got = secrets.scan(make(rows)).collect()
    assert len(got) == len(rows)
    expected = Counter((i, hashlib.sha256(",".join(base_spans(t or "")).encode()).hexdigest()) for i, t in rows)
    assert Counter((r.doc_id, r.base_sha256) for r in got) == expected
    by_id = {r.doc_id: r for r in got}
    assert by_id[9].spans.startswith("private_key:0:31,github:32:")
    assert set(base_spans(TEXTS[12])) <= set(by_id[12].spans.split(","))
    assert (by_id[7].n_assign, by_id[7].n_hex, by_id[7].n_access) == (1, 1, 0)


def test_trigram_queries():
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [["aki", "kia"]]
    assert secrets.trigram_query("[0-9a-f]{24,}") == []
    assert secrets.trigram_query("(abc|xyz)q?d") == [["abc", "bcd"], ["abc", "bcq", "cqd"], ["xyz", "yzd"],
                                                     ["xyz", "yzq", "zqd"]]
    assert secrets.trigram_query("a.*") == [] and secrets.trigram_query("(?:abcd)+x*") == [["abc", "bcd"]]
    for rule in secrets.RULES:
        assert bool(secrets.trigram_query(rule.pattern)) == (rule.kind != "hex")


def test_redaction_keeps_the_rest(make):
    text = "é token=abcdef0123456789abcdef0123456789 then AKIA" + "A" * 16 + " end"
    rows = {r.doc_id: r for r in secrets.redact(make([(1, text), (2, "clean"), (3, None), (4, "")])).collect()}
    assert rows[1].text == "é [SECRET] then [SECRET] end" and rows[1].n_chars == len(rows[1].text)
    assert (rows[2].text, rows[2].n_chars, rows[3].text, rows[4].text) == ("clean", 5, None, "")
    assert rows[1].kinds == "k" and rows[1].order == 1


def test_empty_table(make):
    assert secrets.scan(make([])).count() == 0 and secrets.redact(make([])).count() == 0


def test_main_path_is_native(make):
    plan = secrets.scan(make([(1, "token=abcdefgh")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions", plan)
