"""Pseudonyms against a second Feistel network, and where the key comes from."""

import hashlib

from daycast.llm import pii


def sha(*parts):
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def chars(value, mask, salt, key):
    cut = len(value) // 2
    a, b, ma, mb = value[:cut], value[cut:], mask[:cut], mask[cut:]
    for r in range(1, pii.ROUNDS + 1):
        out = ""
        for i, (c, m) in enumerate(zip(a, ma)):
            alphabet = pii.CLASSES.get(m, c)
            byte = bytes.fromhex(sha(key, salt, r, i // 32, b))[i % 32]
            out += alphabet[(alphabet.index(c) + byte) % len(alphabet)]
        a, b, ma, mb = b, out, mb, ma
    return a + b


def number(value, moduli, salt, key):
    m, n = moduli
    a, b = divmod(value, n)
    for r in range(1, pii.ROUNDS + 1):
        a, b, m, n = b, (a + int(sha(key, salt, r, b)[:15], 16)) % m, n, m
    return a * moduli[1] + b


def test_second_network_agrees(spark):
    texts = [f"mail {n}@x.org and 10.{i}.{7 * i % 256}.9" for i, n in enumerate(["ann", "b.c-d", "Zed99", "x", "averylongname" * 4, "a1"])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r["text"] for r in pii.pseudonymise(df, key="k1").orderBy("doc_id").collect()]
    for t, g in zip(texts, got):
        local, ip = t.split()[1].split("@")[0], t.split()[3]
        mask = "".join("d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "x" for c in local)
        value = int.from_bytes(bytes(map(int, ip.split("."))), "big")
        new = ".".join(map(str, number(value, (65536, 65536), "ip", "k1").to_bytes(4, "big")))
        assert g == f"mail {chars(local, mask, 'email', 'k1')}@x.org and {new}"


def test_key_comes_from_the_session(spark):
    df = spark.createDataFrame([(1, "ann.smith@x.org")], "doc_id long, text string")
    text = lambda s, **kw: pii.pseudonymise(df, **kw).first()["text"]
    spark.conf.unset(pii.KEY_CONF)
    first = text(spark)
    assert first == text(spark) and len(spark.conf.get(pii.KEY_CONF)) == 24  # one key a session
    spark.conf.set(pii.KEY_CONF, "of the deployment")
    assert text(spark) == text(spark, key="of the deployment") != first
    spark.conf.unset(pii.KEY_CONF)
    assert text(spark) != first
