import random
import re
import string

from pyspark.sql import functions as F

from tickforge.llm.secrets import candidates, dictionary, known_format, scan


def corpus():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 22))) for _ in range(300)]
    docs = []
    for i in range(400):
        w = [rng.choice(vocab) for _ in range(60)]
        if i % 4 == 0:
            w[30:33] = ["token", "=", '"' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"']
        if i % 4 == 1:
            w[10] = "".join(rng.choice("0123456789") for _ in range(16))
        if i % 4 == 2:
            w[5] = f"see/{rng.choice(vocab)}/{rng.choice(vocab)}-long-path-name"
        docs.append((i, " ".join(w), f"src{i % 3}"))
    return docs


def test_secrets_are_told_from_other_strings(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = scan(df, path_col="source").collect()
    texts = {i: t for i, t, _ in docs}
    real = {i for i in texts if i % 4 == 0}
    assert {r.doc_id for r in rows if r.is_secret} == real
    for r in rows:
        assert r.secret in texts[r.doc_id].split()[r.word_no]
    assert len({(r.doc_id, r.word_no, r.run_no) for r in rows}) == len(rows)


def test_half_of_the_labels_suffice(spark):
    """Labels of odd findings only; the others are told by the forest."""
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")

    def label(word, run, before):
        half = F.crc32(run) % 2 == 0
        return F.when(half, run.rlike("^[0-9a-f]{40}$"))

    rows = scan(df, label=label).collect()
    right = [r.is_secret == (len(r.secret) == 40 and r.doc_id % 4 == 0) for r in rows]
    assert sum(right) >= 0.99 * len(right)


def test_candidates_and_neighbours(spark):
    df = spark.createDataFrame([(1, '  key : "abcdefgh12345678",x9\nabcdefgh_ABCDEFGH:0123456789012345 end', "p")],
                               "doc_id long, text string, word string")
    got = [(r.word_no, r.run_no, r.run, r.before2, r.before1, r.after1) for r in candidates(df).orderBy("word_no", "run_no").collect()]
    assert got == [(2, 0, "abcdefgh12345678", "key", ":", "abcdefgh_ABCDEFGH:0123456789012345"),
                   (3, 0, "abcdefgh_ABCDEFGH", ":", '"abcdefgh12345678",x9', "end"),
                   (3, 1, "0123456789012345", ":", '"abcdefgh12345678",x9', "end")]


def test_dictionary(spark):
    df = spark.createDataFrame([("Word other x1word ab",), ("word, WORD",), ("(word)",), (None,)], "text string")
    assert [r.part for r in dictionary(df).collect()] == ["word"]


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "a" * 20, 1), (2, None, 1), (3, "", 1), (4, "0123456789abcdef" * 4000, 1), (4, "b" * 20, 1)],
                               "doc_id long, text string, score int")
    rows = scan(df).collect()
    # findings of one label only: its share
    assert sorted((str(r.doc_id), len(r.secret), r.score, r.is_secret) for r in rows) == [
        ("4", 20, 0.0, False), ("4", 64000, 0.0, False), ("None", 20, 0.0, False)]
    assert scan(df.limit(0)).count() == 0


CREDENTIAL = re.compile("(?i)(token|secret|passw|pwd|api.?key|access.?key|credential|auth|bearer|private)")
NAME = re.compile(CREDENTIAL.pattern + r"[A-Za-z0-9_.\]'\"-]*[=:]")


def brute_candidates(text):
    words, out = re.findall(r"[^ \t\n\x0b\f\r]+", text or ""), []
    for k, w in enumerate(words):
        one, two = (words[k - j] if k >= j else "" for j in (1, 2))
        named = one[-1:] in ("=", ":") and one and CREDENTIAL.search(f"{two} {one}") or NAME.search(w) or re.search("://[^/@:]*:[^/@]*@", w)
        runs = re.findall("[A-Za-z0-9_+/=-]{8,}", w) if named else re.findall("[A-Za-z0-9_+/=-]{16,}", w)
        if named:
            runs = [r for r in runs if len(r) >= 16 or not re.search(CREDENTIAL.pattern + "[A-Za-z_-]*=*$", r)]
        out += [(k, n, r) for n, r in enumerate(runs)]
    return out


def test_candidates_equal_plain_python(spark):
    rng = random.Random(9)
    parts = ["token", "=", ":", "password:", "pwd=", "api_key", "the", "author", "abcdefgh", "ab12cd34ef", '"', "x" * 16, " ", " ", "\n",
             "https://u:", "@host/", "MY_SECRET", "short1", "auth-token='", "z9" * 12, ""]
    docs = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 25)))) for k in range(400)] + [(900, None), (901, "")]
    got = sorted((r.id, r.word_no, r.run_no, r.run) for r in candidates(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == sorted((d, *x) for d, t in docs for x in brute_candidates(t)) and len(got) > 300


def some(rng, letters, n):
    return "".join(rng.choice(letters) for _ in range(n))


def test_formats_that_no_label_covers(spark):
    """Base64 keys, mixed-case tokens and short passwords behind a credential
    word have no label; the forest finds them, not the names and numbers."""
    rng = random.Random(4)
    mixed, hexa = string.ascii_letters + string.digits, "0123456789abcdef"
    vocab = [some(rng, "abcdefghij", rng.randrange(3, 20)) for _ in range(300)]
    known = [lambda: f'token = "{some(rng, hexa, 40)}"', lambda: f"api_key={some(rng, hexa, 32)}", lambda: f"secret: {some(rng, hexa, 64)}",
             lambda: f"AKIA{some(rng, string.ascii_uppercase + string.digits, 16)}", lambda: f"token: ghp_{some(rng, mixed, 36)}",
             lambda: f"postgres://app:{some(rng, mixed, 11)}7a@db.host/x"]
    held_out = [lambda: f'auth_token="{some(rng, mixed, 43)}1a"', lambda: f"private_key: {some(rng, mixed + '+/', 64)}9z==",
                lambda: f"password = {some(rng, mixed, 10)}4b"]
    clean = [lambda: some(rng, string.digits, 18), lambda: f"https://site.org/{rng.choice(vocab)}-{rng.choice(vocab)}/page-name-of-it",
             lambda: f"/usr/lib/{rng.choice(vocab)}/{rng.choice(vocab)}_module_name", lambda: f"password: {rng.choice(vocab)}",
             lambda: "=" * 30, lambda: f"{rng.choice(vocab)}_{rng.choice(vocab)}_{rng.choice(vocab)}_x"]
    docs, kind = [], {}
    for i in range(900):
        group = (known, held_out, clean)[i % 3]
        kind[i] = group
        w = [rng.choice(vocab) for _ in range(40)]
        w[20] = rng.choice(group)()
        docs.append((i, " ".join(w)))
    rows = scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {r.doc_id for r in rows if r.is_secret}

    def share(group):
        own = [i for i in kind if kind[i] is group]
        return len(found & set(own)) / len(own)

    assert share(known) >= 0.97 and share(held_out) >= 0.9 and share(clean) <= 0.03


def test_labels_of_formats(spark):
    cases = [("AKIA" + "A1" * 8, "AKIA" + "A1" * 8, "", True), ("https://u:ab12cd34@h/", "ab12cd34", "", True),
             ("https://h/?api_key=ab12cd34ef", "ab12cd34ef", "", None), ("https://h/path-of-a-long-page", "/path-of-a-long-page", "", False),
             ("sha256:" + "a1" * 32, "a1" * 32, "", None), ("secret:" + "a1" * 32, "a1" * 32, "", True), ("1" * 20, "1" * 20, "token:", False),
             ('"' + "a1" * 16 + '"', "a1" * 16, "=", True), ("Ab1" * 10, "Ab1" * 10, "token:", None)]
    df = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(cases)], "k int, word string, run string, before string")
    got = [r.v for r in df.select("k", known_format(F.col("word"), F.col("run"), F.col("before")).alias("v")).orderBy("k").collect()]
    want = [c[3] for c in cases]
    want[2] = True  # a query parameter named by a credential word
    assert got == want


def test_reviewed_findings_come_first(spark):
    docs = [(i, f"key {'ab12' * 5}{i:03d} and name_of_a_thing_{'xyz'[i % 3]}_long") for i in range(90)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    reviewed = spark.createDataFrame([(f"{'ab12' * 5}{i:03d}", True) for i in range(45)]
                                     + [(f"name_of_a_thing_{c}_long", False) for c in "xy"] + [("name_of_a_thing_z_long", True),
                                        ("name_of_a_thing_z_long", False), (None, True)], "secret string, is_secret boolean")
    rows = scan(df, reviewed=reviewed, label=lambda word, run, before: F.lit(None).cast("boolean")).collect()
    assert len(rows) == 180 and all(r.is_secret == r.secret.startswith("ab12") for r in rows)
