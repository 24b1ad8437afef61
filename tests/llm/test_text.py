"""Quality rules, secrets, tokens and chat formatting."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import brute
from threatlake.llm import chat, pieces, quality, secret_scan
from threatlake.llm.queries import QUERIES, SELF_QUOTING, tokenizer

ODD = [None, "", " \n\t\n", "one", "a b c\na b c\na b c", "x\x0by z", "é" * 3, "w " * 60_000, "\U0001f600 " * 70, "# * $ % & | < >\n" * 20]


def frame(spark, texts, more=""):
    rows = [(i, t, i % 3, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, n_words int, quality string{more}")


def texts(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def test_quality_base_columns(spark, sf):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = {r.doc_id: tuple(r[n] for n in names) for r in QUERIES["op2_quality_rules"](spark, sf).collect()}
    assert got == {d: brute.base_quality(t) for d, t in texts(spark, sf)}
    out = quality.judged(frame(spark, ODD)).collect()
    assert [tuple(r["quality_"][n] for n in names) for r in out] == [brute.base_quality(t) for t in ODD]


def test_quality_rules_by_line():
    prose = "This is a line of plain prose, with a full stop at its end."
    lines = {"home | about | news | contact | login": "navigation", "All rights reserved.": "boilerplate", "BUY!! NOW!! OR!! NEVER!!": "symbols",
             "these are many words in a row without any mark at all here": "punctuation", prose: None, "A title": None}
    for line, rule in lines.items():
        assert quality.failing_rule(line, line.encode(), line.encode().split(), quality.RULES) == rule, line
    good = " ".join(f"word{i}," for i in range(60))
    judged = quality.judge(f"{good}\nhome | about | news | login", quality.RULES)
    assert judged[-2:] == (True, good) and judged[5] == 1
    mostly = "\n".join(f"a{i} | b{i} | c{i} | d{i}" for i in range(30)) + "\n" + good
    assert quality.judge(mostly, quality.RULES)[-2] is False


def test_quality_cleaned(spark):
    good = " ".join(f"word{i}," for i in range(60))
    docs = spark.createDataFrame([(1, good + "\nback to top", "s", 5, "q"), (2, "short", "s", 5, "q"), (None, None, None, None, None)], "doc_id long, text string, source string, n_chars long, quality string")
    assert [tuple(r) for r in quality.cleaned(docs).collect()] == [(1, good, "s", len(good), "q")]
    assert quality.cleaned(docs.limit(0)).columns == docs.columns
    with pytest.raises(ValueError):
        quality.judged(docs, no_such_rule=1)


def test_secrets_base(spark, sf):
    rng = random.Random(5)
    bits = ["password", "PassWd", "tok", "token", "api_key", "APIKEY", "secret", '"', "'", " ", "=", ":", "abc123XYZ", "AKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "é", "\n", "ſecret", "toKen", "-_.=", "a" * 30]
    more = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    given = frame(spark, [*ODD, *more])
    for r, t in zip(secret_scan.scanned(given, "s").orderBy("doc_id").collect(), [*ODD, *more]):
        spans = brute.secret_spans(t)
        assert r.s.base == ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans), repr(t)
        assert (r.s.n_assign, r.s.n_access, r.s.n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
        assert set(filter(None, r.s.base.split(","))) <= set(r.s.spans.split(","))
    got = {r.doc_id: r.base_sha256 for r in QUERIES["op8_secret_scan"](spark, sf).collect()}
    for d, t in texts(spark, sf):
        joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in brute.secret_spans(t))
        assert got[d] == hashlib.sha256(joined.encode()).hexdigest()


def test_entropy_windows_and_allow_list():
    rng = random.Random(6)
    for _ in range(200):
        run = "".join(rng.choice("0123456789abcdef"[: rng.randint(1, 16)]) for _ in range(rng.randint(0, 90)))
        assert secret_scan.windows(run, 20, 3.0) == brute.entropy_windows(run, 20, 3.0)
    scanner = secret_scan.Scanner(secret_scan.CLASSES, secret_scan.ALLOW)
    assert "entropy_base64:4:" in scanner.scan("key " + "aZ3kQ9xW7bV1nM5tR8yP2cD6")[4]
    for safe in ("internationalisation" * 2, "9" * 40, "SomeLongCamelCaseIdentifierName", "abcdefabcdefabcdefabcdef", "Version2024"):
        assert scanner.scan(safe)[4].count("entropy") == 0, safe


@pytest.fixture(scope="module")
def library():
    return pieces.load(tokenizer())


def test_pieces_equal_the_library(spark, sf, library):
    rng = random.Random(7)
    bits = ["a", "b", " ", "  ", "\n", "\t", "▁", "<s>", "</s>", "<0x0A>", "é", "漢", "\U0001f600", "word", "the", " the", "\x00", "\u2028", ".", "<unk>", "      ", "ﬁ", "\r"]
    every = [*ODD, *("".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(4000)), *(t for _, t in texts(spark, sf))]
    out = pieces.decoded(pieces.encoded(frame(spark, every), tokenizer(), table=500), tokenizer()).orderBy("doc_id").collect()
    for r, t in zip(out, every):
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids), repr(t)[:80]
        assert r.decoded == library.decode(ids)
    assert pieces.encoded(frame(spark, ["x"]).limit(0), tokenizer()).count() == 0


def test_pieces_query(spark, sf, library):
    got = {r.doc_id: r for r in QUERIES["op7_sentencepiece"](spark, sf).collect()}
    for d, t in texts(spark, sf):
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        assert got[d].n_tokens == len(ids) and got[d].ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int, segments int")


def test_chat_round_trip(spark):
    rng = random.Random(8)
    marks = [*chat.Template().marks(), "\\", "[", "<", "]", ">", "/", "INST]", "<\\s>", "[\\\\INST]", "ok", " ", "\n", "é", "<<", "SYS>>", "<</SYS>"]
    rows = []
    for c in range(1500):
        for t in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", "tool", "[/ROLE]", "", None, "[INST]"])
            rows.append((c if c else None, t, role, rng.choice([None, "".join(rng.choice(marks) for _ in range(rng.randint(0, 12)))]), 1, 1))
    out = chat.formatted(conversations(spark, rows)).select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss"), "segments")
    want = {}
    for c, _, role, text, *_ in rows:
        want.setdefault(c, []).append((role or "", text or ""))
    got = {r.conv_id: r for r in out.collect()}
    assert got.keys() == want.keys()
    for c, said in want.items():
        assert [tuple(t) for t in got[c].turns] == said, got[c].formatted
        assert got[c].loss == "".join(t for r, t in said if r == "assistant")
        assert "".join(s.text for s in got[c].segments) == got[c].formatted


def test_chat_machine(spark):
    def bad(*roles):
        r = chat.formatted(conversations(spark, [(1, i, role, "x", 0, 0) for i, role in enumerate(roles)])).first()
        return r.first_bad, r.ended

    assert bad("system", "user", "assistant") == (None, True)
    assert bad("user", "assistant", "user") == (None, False)
    assert bad("assistant") == (0, True)
    assert bad("user", "user", "assistant", "system") == (1, False)
    assert bad("user", "tool") == (1, False)
    assert chat.formatted(conversations(spark, [(1, 0, "user", "x", 0, 0)]).limit(0)).count() == 0
    twice = chat.formatted(conversations(spark, [(1, 0, "user", "x", 0, 0)] * 2))
    assert twice.first().first_bad == 1 and chat.segment_rows(twice).count() == 6


def test_chat_template_is_checked():
    with pytest.raises(ValueError):
        chat.Template(roles={"user": chat.Role("<a>", "<a>b")}).check()
    with pytest.raises(ValueError):
        chat.Template(roles={"user": chat.Role("<a", "a>")}, other=("(1", "(2", "(3")).check()


def test_chat_query_is_native_and_has_the_quoting_conversation(spark, sf):
    df = QUERIES["op4_chat_format"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    row = df.where("conv_id = -7").first()
    said = SELF_QUOTING[0][3]
    assert row.n_turns == 2 and row.loss_chars == len(said) and row.first_bad is None
    assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in SELF_QUOTING).encode()).hexdigest()
