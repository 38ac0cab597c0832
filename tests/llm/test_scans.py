"""Token counts, secrets, benchmark passages and personal data against plain versions."""

import public_tokenizers
import pytest
from hypothesis import HealthCheck, given as cases, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from wattline.llm import decontamination, personal_data, secret_scan, token_counts

ODD = [
    None, "", " ", "\n\t", "é" * 40, "x" * 70_000, "a b " * 30_000, "\U0001f600 \U0001f600",
    "tail space wide", "<|endoftext|> end <|endoftext|>",
]

SECRETS = [
    "password=abcdefgh", "PassWord : 'abc'", "password: token: abcdefghij", "api_key=\"ABCDEFGHIJ\"",
    "APIKEY=========", "secret=secret=secret=abcdefgh", "AKIAAKIAAKIA1234 AKIA1", "xAKIA" + "A" * 30,
    "0123456789abcdef" * 2, "g" + "ab" * 40 + "g", "ſecret=abcdefgh12", "toKen=abcdefgh12",
    "é" * 5 + "token='" + "a1" * 30 + "' and passwd =x.y.z.w.v.u", "password=\n=abcdefgh",
    "token" + " " * 50 + "=" + " " * 50 + "abcdefgh", ("password=abcdefgh1 " * 500),
]

PERSONAL = [
    "a@b.c@d.e", "a@b@c.d", ".%+-@-.-", "x@y", "x@y.", "x@y..z", "@a.b", "a.b@c.d.e, f@g.h",
    "1.2.3.4.5.6.7.8.9", "256.1.1.1", "0001.002.03.255", "1.2.3", "1.2.3.4.", "999999.1.1.1.1.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111", "41111111111111111111111", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "+1 (234) 567-8901", "+1", "+12", "+123", "+1(((((((((((((2", "+1 234 567 890 12 +1 2", "++1 234567890 12345 .",
    "é +49 30 1234 5678 é 10.0.0.1é", "+1.1.1.1.1.1.1.1.1.1", "mail 4012888888881881x@y.zz",
]


def _collected(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_token_counts_equal_the_library(documents, given):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    texts = ODD + [r["text"] for r in given("documents").limit(200).collect()]
    found = _collected(token_counts.count_tokens(documents(texts), path))
    for k, text in enumerate(texts):
        n = len(whole.encode(text or "", add_special_tokens=False))
        assert (found[k]["n_bytes"], found[k]["n_tokens"], found[k]["over_limit"]) == (
            len((text or "").encode()), n, n > 512,
        )


@settings(max_examples=150, deadline=None)
@cases(st.text(alphabet="ab '\n1.é<|endoftext|> \x1c", max_size=120))
def test_pieces_rejoin_and_count_alike(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    parts = list(token_counts.pieces(text, 3))
    assert "".join(parts) == text
    whole = token_counts._LOADED.setdefault(path, Tokenizer.from_file(path))
    count = lambda x: len(whole.encode(x, add_special_tokens=False))
    assert sum(map(count, parts)) == count(text)


def _check_secrets(found, texts):
    for k, text in enumerate(texts):
        base = brute.secret_base(text or "")
        row = found[k]
        for kind in secret_scan.KINDS[:3]:
            assert row[f"n_{kind}"] == sum(s[0] == kind for s in base), (kind, text)
        assert row["base_sha256"] == brute.sha(brute.listed(base, secret_scan.KINDS)), text
        spans = [tuple(s.split(":")) for s in row["spans"].split(",") if s]
        assert {(k, int(a), int(b)) for k, a, b in spans} >= set(base)


@pytest.fixture(scope="module")
def model(spark):
    from tests.llm.conftest import SMALL
    from wattline.llm.workers import importable

    return secret_scan.sample_and_train(importable(spark), spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_secret_base_spans(documents, given, model):
    texts = ODD + SECRETS + [r["text"] for r in given("documents").collect()]
    _check_secrets(_collected(secret_scan.find_secrets(documents(texts), model)), texts)


def test_random_text_secret_base_spans(documents, model):
    import random

    rng = random.Random(7)
    parts = ["password", "Token", "api_key", "=", ":", " ", "'", "AKIA", "AB12", "0a", "f" * 9, "é", "\n", "-", "x.y"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(600)]
    _check_secrets(_collected(secret_scan.find_secrets(documents(texts), model)), texts)


def test_markov_models_tell_held_out_strings_apart(spark, documents, model):
    import hashlib
    import base64

    held = [base64.b64encode(hashlib.sha256(f"held out {k}".encode()).digest()).decode()[:32] for k in range(200)]
    plain = [
        f"{a}_{b}_{c}_2024" for a in ("customer", "invoice", "shipping", "database")
        for b in ("address", "number", "connection") for c in ("updated", "archive", "settings", "handler")
    ]
    rows = documents([f"see {x} there" for x in held + plain])
    spans = [r["spans"] for r in secret_scan.find_secrets(rows, model).orderBy("doc_id").collect()]
    caught = sum("random" in s for s in spans[: len(held)])
    wrong = sum("random" in s for s in spans[len(held) :])
    assert caught >= 0.97 * len(held) and wrong <= 0.03 * len(plain)


def test_redaction_leaves_no_base_secret_and_nothing_else_changes(documents, given, model):
    texts = ODD + SECRETS + [r["text"] for r in given("documents").collect()]
    df = documents(texts).select("doc_id", secret_scan.redact(F.col("text"), model).alias("text"))
    found = {r["doc_id"]: r["text"] for r in df.collect()}
    flagged = _collected(secret_scan.find_secrets(documents(texts), model))
    for k, text in enumerate(texts):
        if not flagged[k]["spans"]:
            assert found[k] == text
        else:
            assert found[k] != text
            assert not [s for s in brute.secret_base(found[k]) if s[0] != "assign"]


def test_no_rows_no_secrets(documents, model):
    assert secret_scan.find_secrets(documents([]), model).count() == 0
    assert secret_scan.train(secret_scan.labelled_sample(documents([]), 10))


def test_secret_sample_takes_whole_distinct_texts(documents):
    words = [a + b for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "sto", "ting", "vel", "wund")]
    rows = [" ".join(words)] * 500 + [None] * 200
    plain = secret_scan.labelled_sample(documents(rows), 20).where("not random")
    tokens = [r["token"] for r in plain.collect()]
    assert len(tokens) == 7 * 4  # 25 words are four runs
    assert all(any(w in t.lower() for t in tokens) for w in words)


def test_leaks(documents, given, spark):
    items = [(r["item_id"], r["text"]) for r in given("benchmark").collect()]
    items += [(900, "One two"), (901, "..."), (902, None), (903, "straße Ünder İ 9x"), (None, "zig zag zog")]
    items += [(904, " ".join(["rep"] * 30))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ODD + [r["text"] for r in given("documents").collect()]
    texts += ["one TWO three", "xone two", "one-two", "STRAßE Ünder İ 9X", "zig zag zog", "rep " * 25, "rep " * 9]
    texts += [items[3][1] * 2, items[3][1][: len(items[3][1]) // 2]]
    expected = {k: brute.leaks(t, items) for k, t in enumerate(texts)}
    for bound in (1 << 20, 0):
        part = texts if bound else texts[:120] + texts[-9:]
        keep = list(range(len(texts))) if bound else [*range(120), *range(len(texts) - 9, len(texts))]
        frame = documents([(k, texts[k]) for k in keep])
        for r in decontamination.find_leaks(frame, bench, broadcast_bytes=bound).collect():
            assert (r["n_words"], r["n_hit"], r["items"]) == expected[r["doc_id"]], (bound, r["doc_id"])
        assert len(part) == len(keep)


def test_removing_leaks(documents, spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = documents([(1, "say Alpha, beta gamma now"), (2, "alpha beta"), (None, "x"), (3, None), (1, "other")])
    assert sorted(map(str, (r["text"] for r in decontamination.remove_spans(rows, bench).collect()))) == sorted(
        ["say   now", "alpha beta", "x", "None", "other"]
    )
    kept = decontamination.remove_documents(rows, bench).collect()
    assert sorted(str(r["text"]) for r in kept) == ["None", "alpha beta", "other", "x"]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.remove_documents(rows, empty).count() == 5
    assert decontamination.find_leaks(documents([]), bench).count() == 0


def _personal(text):
    return [s for s in personal_data.find_spans(text) if s[0] in personal_data.KINDS[:4]]


def test_personal_data(documents, given):
    texts = ODD + PERSONAL + [r["text"] for r in given("documents").collect()]
    found = _collected(personal_data.find_personal_data(documents(texts)))
    for k, text in enumerate(texts):
        base = brute.personal_base(text or "")
        row = found[k]
        for kind in personal_data.KINDS[:4]:
            assert row[f"n_{kind}"] == sum(s[0] == kind for s in base), (kind, text)
        assert row["base_sha256"] == brute.sha(brute.listed(base, personal_data.KINDS)), text


@settings(max_examples=4000, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@cases(st.text(alphabet="a1.2@-+ ()5%é\n", max_size=60))
def test_personal_data_grammar(text):
    kinds = personal_data.KINDS
    assert brute.listed(_personal(text), kinds) == brute.listed(brute.personal_base(text), kinds)


def test_accounts_and_logins():
    kinds = lambda t: [(k, t[a:b]) for k, a, b in personal_data.find_spans(t) if k in ("account", "login")]
    assert kinds("IBAN: GB82 WEST 1234 5698 7654 32 now") == [("account", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("IBAN: GB82 WEST 1234 5698 7654 33 now") == []
    assert kinds("my SSN 123-45-6789.") == [("account", "123-45-6789")]
    assert kinds("account number 12345678901, thanks") == [("account", "12345678901")]
    assert kinds("ftp://bob:hunter2@host.example/x") == [("login", "bob:hunter2@host.example")]
    assert kinds("https://host.example/a:b") == [] and kinds("on account of this we left") == []
    assert personal_data.redact("to a@b.cc at 10.0.0.1") == "to [email] at [ip]"
