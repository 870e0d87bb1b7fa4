import hashlib
import random

from feedback_lens.llm import fingerprints as fp


def brute(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = fp.fingerprint(text), fp.fingerprint(edited), fp.fingerprint(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=str)


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "éa", "zu", "ing"]) + str(rng.randrange(50)) for _ in range(n))


def test_edits_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 7)
    rng = random.Random(3)
    rows = [(rng.randrange(-1000, 1000) ** 3, words(rng, rng.choice([0, 1, 2, 30]))) for _ in range(90)] + [(5, "same"), (5, "same"), (5, None), (None, "x y"), (None, "")]
    for part in (rows, rows[:1], [(None, "a b")]):
        df = spark.createDataFrame([(*r, 1.0) for r in part], "doc_id long, text string, near_next double")
        assert sorted(map(tuple, fp.edited_fingerprints(df).collect()), key=str) == brute(part)
    assert fp.edited_fingerprints(df.limit(0)).count() == 0


def test_votes():
    text = "a b c a b"
    terms = ["a b", "b c", "c a", "a b"]
    assert fp.fingerprint("") == bytes(fp.BITS // 8) and fp.fingerprint("A  b") == fp.fingerprint("a b")
    votes = [int.from_bytes(fp.fingerprint(t)) for t in terms]
    want = sum(1 << bit for bit in range(fp.BITS) if 2 * sum(v >> bit & 1 for v in votes) > len(votes))
    assert int.from_bytes(fp.fingerprint(text)) == want


def test_neighbours_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 10)
    rng = random.Random(4)
    base = [rng.getrandbits(fp.BITS) for _ in range(12)]
    prints = []
    for i in range(240):
        value = base[i % 12]
        for _ in range(rng.randrange(6)):
            value ^= 1 << rng.randrange(fp.BITS)
        prints.append((i, f"{value:0{fp.BITS // 4}x}"))
    df = spark.createDataFrame(prints, "doc_id long, fingerprint string")
    queries = df.where("doc_id % 5 = 0")
    for radius in (0, 3, 8):
        got = sorted(map(tuple, fp.neighbours(queries, df, radius).collect()))
        want = sorted(
            (a, b, d) for a, x in prints if a % 5 == 0 for b, y in prints if a != b and (d := (int(x, 16) ^ int(y, 16)).bit_count()) <= radius
        )
        assert got == want
