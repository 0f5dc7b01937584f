import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.mixture import mixture, source_name
from corpusloom.llm.packing import BestFit, fill_report, packed
from corpusloom.llm.records import record_classes, record_counts
from corpusloom.llm.residue import find_residue, residue_on_unseen_kinds, train_residue, weak_label
from corpusloom.llm.shapes import parts_of, pieces
from corpusloom.llm.tokens import VOCABULARY, count, encoder, slices, token_counts

LABELS, BODY = ("birim", "esas no"), "metin"


def classes(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "r") for i, t in rows], "documentid long, mdtext string, id string, root string")
    return record_classes(df, "documentid", "mdtext", LABELS, BODY)


def test_records(spark):
    same = [
        (5, "Birim: 3. Hukuk ; Esas No: 1/2 ; Metin: Işık ÇAĞI, iyi."), (3, "**Esas No:** 1/2\n**Birim:** 3. hukuk\n\n## Metin\n\nIŞIK çağı iyi"), (9, "BİRİM 3 HUKUK  ESAS NO 12 METİN İŞI\u200bK ÇAG\u0306I İYİ"),
        (9, "| Birim | 3. Hukuk |\n| Esas No | 1/2 |\n\nMetin ışık çağı iyi"),
    ]
    other = [
        (1, "Birim: 3. Hukuk ; Metin: Işık çağı, iyi."), (2, "Birim: 3. Hukuk ; Esas No: 1/2 ; Metin: iyi ışık çağı"), (4, "Birim: 3. Hukuk ; Esas No: 1/2 ; Metin: Işık çagı iyi"), (6, "Birim: 1/2 ; Esas No: 3. Hukuk ; Metin: Işık çağı iyi"), (7, "Işık çağı iyi"),
    ]
    left_out = [(None, same[0][1]), (8, None), (10, " \n "), (11, "")]
    got = {(r.keep, r.id, r.n_rows) for r in classes(spark, same + other + left_out).collect()}
    assert got == {(3, 3, 1), (3, 5, 1), (3, 9, 2), *[(i, i, 1) for i, _ in other]}
    assert {(r.keep, r.n_ids, r.n_rows) for r in record_counts(classes(spark, same)).collect()} == {(3, 3, 4)}
    assert classes(spark, []).count() == 0
    assert {(r.keep, r.id) for r in classes(spark, [(1, "..."), (2, "---"), (3, "metin x"), (3, "other")]).collect()} == {(1, 1), (1, 2), (3, 3)}


def test_a_large_group_of_copies(spark):
    rows = [(i, f"Birim: a{' ' * (i % 7)} ; Metin: {'b' if i % 3 else 'B'}") for i in range(600)] + [(1000 + i, f"Metin: {i}") for i in range(600)]
    got = {(r.keep, r.id) for r in classes(spark, rows).collect()}
    assert got == {(0, i) for i in range(600)} | {(1000 + i, 1000 + i) for i in range(600)}


@pytest.mark.parametrize(
    "text", ["Davanın kabulüne karar verilmiştir. " * 9000, "a" * 250_000, "ab1" * 90_000, " " * 250_000 + "son", ("x" + " " * 700) * 400, "it's  '5 \n\n y " * 20_000, "ğ, 12.5'te\t" * 30_000, "١٢ ab　c" * 40_000]
)
def test_slices_change_no_count(text):
    assert "".join(slices(text, 1000)) == text
    whole = len(encoder(VOCABULARY).encode_ordinary(text))
    assert count(text, VOCABULARY) == whole and sum(len(encoder(VOCABULARY).encode_ordinary(s)) for s in slices(text, 1000)) == whole


def test_tokens(spark):
    assert count("", VOCABULARY) == 0
    df = spark.createDataFrame([(1, "a b", "t"), (2, None, "t"), (3, " \n", "t"), (None, "x", "t"), (4, "<|endoftext|>", "t")], "doc_id int, text string, n_tokens string")
    got = {r.doc_id: r.n_tokens for r in token_counts(df, "doc_id", "text").collect()}
    assert set(got) == {1, 4} and got[1] == 2 and got[4] > 1


def by_hand_best_fit(sizes, capacity, most):
    bins, made, out = [], 0, []
    for n in sizes:
        fits = [b for b in bins if b[1] >= n]
        if fits:
            least = min(b[1] for b in fits)
            b = [b for b in fits if b[1] == least][-1]
            bins.remove(b)
        else:
            if len(bins) >= most:
                fullest = min(b[1] for b in bins)
                bins.remove([b for b in bins if b[1] == fullest][-1])
            b = (made, capacity)
            made += 1
        out.append(b[0])
        if b[1] > n:
            bins.append((b[0], b[1] - n))
    return out


def test_best_fit():
    random.seed(4)
    sizes = [random.randint(1, 40) for _ in range(2000)]
    fit = BestFit(50, 7)
    assert [fit.place(n) for n in sizes] == by_hand_best_fit(sizes, 50, 7)


@pytest.mark.parametrize("lanes", [None, 5])
def test_packing(spark, lanes):
    random.seed(5)
    sizes = {i: random.choice([1, 5, 30, 64, 65, 200, 700]) for i in range(800)}
    df = spark.createDataFrame([*[(i, n, "k") for i, n in sizes.items()], (None, 4, "k"), (9001, None, "k"), (9002, 0, "k")], "doc_id long, n_tokens int, container string")
    kinds = spark.createDataFrame([("s", 64), ("l", 256), ("none", None), ("zero", 0)], "container_name string, capacity_tokens int")
    first = sorted(map(tuple, packed(df, kinds, lanes=lanes).collect()))
    assert first == sorted(map(tuple, packed(df.repartition(3), kinds, lanes=lanes).collect()))
    for name, capacity in (("s", 64), ("l", 256)):
        own = [r for r in first if r[0] == name]
        load, placed = {}, {}
        for _, container, doc, piece, pieces, start, n in own:
            load[container] = load.get(container, 0) + n
            placed.setdefault(doc, []).append((piece, start, n))
            assert pieces == -(-sizes[doc] // capacity) and start == piece * capacity
        assert max(load.values()) <= capacity and set(placed) == set(sizes)
        assert all(sum(n for _, _, n in p) == sizes[d] and len(p) == len(set(p)) for d, p in placed.items())
    report = {r.container_name: r for r in fill_report(packed(df, kinds, lanes=1), kinds).collect()}
    assert set(report) == {"s", "l"} and report["l"].filled > 0.95
    assert packed(df.limit(0), kinds).count() == 0 and packed(df, kinds.limit(0)).count() == 0


WORDS = {"a": "court appeal judge ruling", "b": "recipe flour butter oven", "c": "goal match player league"}


def corpus(spark):
    random.seed(6)
    rows, i = [], 0
    for source, n in (("A", 300), (" b", 100), ("c", 40), ("D-e", 60)):
        for _ in range(n):
            words = random.choices(WORDS.get(source.strip().lower(), "other thing").split(), k=random.randint(5, 60))
            rows.append((i, f"{' '.join(words)} {i}", source, "x"))
            i += 1
    rows += [(i + j, f"{WORDS['b']} unlabelled {j}", None, "x") for j in range(10)]
    # Copies count under a source with a target, though the smallest id has none.
    rows += [(1000, "twice the same text", "D-e", "x"), (1001, "twice the same text", None, "x"), (1002, "twice the same text", "c", "x")]
    rows += [(9000 + j, rows[0][1], "A", "x") for j in range(50)] + [(9900, None, "A", "x"), (9901, " ", "A", "x"), (None, "text", "A", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, id string")


def test_mixture(spark):
    targets = spark.createDataFrame([("a", 0.3, 1), ("B", 0.4, 4), ("c", 0.2, 6), ("gone", 0.1, 2), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    mixed = mixture(corpus(spark), targets)
    assert mixed.converged and mixed.residual <= 1e-3 and mixed.rounds > 0
    stopped = mixture(corpus(spark), targets, rounds=1)
    assert not stopped.converged and stopped.rounds == 1 and not stopped.shares.first().converged
    soft = {r.source: r for r in mixture(corpus(spark), targets, trust=0.5).shares.collect()}
    assert all(abs(soft[s].expected_share - t / 0.9) < 0.03 for s, t in (("a", 0.3), ("B".lower(), 0.4), ("c", 0.2)))
    shares = {r.source: r for r in mixed.shares.collect()}
    assert set(shares) == {"a", "b", "c", "gone"} and shares["gone"].n_docs == 0
    for source, share in (("a", 0.3), ("b", 0.4), ("c", 0.2)):
        assert abs(shares[source].reached_share - share / 0.9) < 0.02
    chosen = mixed.chosen.collect()
    assert len({r.doc_id for r in chosen}) == len(chosen) and all(1 <= r.repeats <= {"a": 1, "b": 4, "c": 6}[r.source] for r in chosen)
    assert not [r for r in chosen if r.doc_id >= 9000] and any(500 <= r.doc_id < 510 and r.source == "b" and r.repeats == 1 for r in chosen)
    assert not [r for r in chosen if r.doc_id in (1000, 1001)] and [r.source for r in chosen if r.doc_id == 1002] == ["c"]
    assert mixture(corpus(spark).limit(0), targets).chosen.count() == 0
    nothing = mixture(corpus(spark), targets.limit(0))
    assert nothing.chosen.count() == 0 and nothing.shares.count() == 0


def test_source_names(spark):
    df = spark.createDataFrame([(s,) for s in ("Yuksek Mahkeme", "YUKSEK_MAHKEME", " yuksek-mahkeme\t", "", "  ", None)], "s string")
    assert [r[0] for r in df.select(source_name(F.col("s"))).collect()] == ["yuksek_mahkeme"] * 3 + [None] * 3


SOUND = [
    "Davacı A... B... vekili duruşmada hazır bulundu.", "Sözleşmenin \"[tarih]\" bölümünün doldurulmadan imzalandığı ileri sürülmüştür.", "[Değişik bent] Ücret, %9 oranını aşamaz.", "(1) ve {2} numaralı bentler birlikte okunmalıdır.",
    "Bilirkişi raporunda \"undefined\" ve \"NaN\" çıktısı veren 43 kayıt ayıklanmıştır.", "Tanık, ekranda yalnızca \"lütfen daha sonra yeniden deneyiniz\" yazısının belirdiğini söylemiştir.", "Davalı, formdaki '<ilce>' kutusunu kendisinin doldurmadığını savunmuştur.",
    "Karar 12.03.2014 tarihinde tebliğ edilmiştir.", "☰ Menü", "Kira bedeli aylık 1.200 TL, depozito 2.400 TL olarak kararlaştırılmıştır.", "Bozma ilamına uyan mahk",
]
FAULTY = [
    "Kira bedeli aylık {{TUTAR}} TL, depozito 2.400 TL olarak kararlaştırılmıştır.", "Davacı [davacı adı giriniz] vekili duruşmada hazır bulundu.", "Karar ________ tarihinde tebliğ edilmiştir.", "Karar null tarihinde tebliğ edilmiştir.", "Sayın <<ad>>, başvurunuz alındı.",
    "HTTP Status 404 – Not Found", "Traceback (most recent call last):", "Bu sayfayı görüntülemek için JavaScript gereklidir.", "BU SAYFAYI GÖRÜNTÜLEMEK İÇİN JAVASCRİPT GEREKLİDİR.", "lorem ipsum dolor sit amet congue", "asdf asdf asdf asdf asdf",
]


def in_parts(texts):
    out = [[] for _ in texts]
    for i, data, offsets in pieces(pa.array(texts, pa.string())):
        p = parts_of(data, offsets)
        for t, a, b in zip(p.text, p.start, p.end):
            out[i + t].append(p.folded[a:b].strip())
        assert len(p.index) == len(p.owner) and (len(p.owner) == 0 or p.owner.max() == len(p.text) - 1)
    return out


def test_weak_labels():
    found = [any(map(weak_label, p)) for p in in_parts(SOUND + FAULTY)]
    assert found == [False] * len(SOUND) + [True] * len(FAULTY)
    assert not weak_label(b"karar {{tarih}} gunu", ("braces",)) and weak_label(b"karar {{tarih}} gunu", ("angles",))


def test_parts():
    got = in_parts(['Sayın "Ali Bey. Evet" geldi. Ayşe\'nin IŞIĞI iyi!\n\nİkinci: “a. b” 3.5 …', None, "", " \n", "tek \" işaret. son", "a" * 10])
    assert got == [[b'sayin "ali bey. evet" geldi.', b"ayse'nin isigi iyi!", b'ikinci: "a. b" 3.5 ...'], [], [], [], [b'tek " isaret.', b"son"], [b"a" * 10]]
    # The same words give the same features, wherever they stand and in whatever letters.
    one, two = (parts_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for t in ("Önce. Işık ÇOK iyi.", "Uzun bir cümle önce. isik cok iyi."))
    assert set(one.index[one.owner == 1]) == set(two.index[two.owner == 1])
    long = ["x. " * 1_000_000, "kısa"]
    assert [len(p) for p in in_parts(long)] == [1_000_000, 1]


def test_residue(spark):
    random.seed(7)
    rows = []
    for i in range(400):
        body = [random.choice(SOUND) for _ in range(4)]
        if i % 8 == 0:
            body[random.randrange(4)] = random.choice(FAULTY)
        rows.append((i, "\n".join(body), "x"))
    rows += [(900, None, "x"), (901, "", "x"), (902, " \n", "x"), (903, "Sound words. " * 20_000 + "Karar null tarihinde tebliğ edilmiştir.", "x"), (904, rows[0][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string")
    got = {r.doc for r in find_residue(df, "doc_id", "text").collect()}
    assert got == {i for i in range(400) if i % 8 == 0} | {903, 904}
    unseen = [(i, f"Karar {w} tarihinde tebliğ edilmiştir.") for i, w in enumerate(["[tebliğ günü giriniz]", "12.03.2014", "{{gun}}", "5.6.2001"])]
    model = train_residue(df, "doc_id", "text")
    assert {r.doc for r in model.faulty(spark.createDataFrame(unseen, "doc_id int, text string"), "doc_id", "text").collect()} == {0, 2}
    unseen_kinds = residue_on_unseen_kinds(df, "doc_id", "text").collect()
    assert len(unseen_kinds) == 4 and all(r.n_weak > 0 and r.n_both <= r.n_weak for r in unseen_kinds)
    assert find_residue(df.limit(0), "doc_id", "text").count() == 0
    assert find_residue(df.filter("doc_id = 1"), "doc_id", "text").count() == 0


def test_folding_agrees_with_unicode(spark):
    from corpusloom.llm.records import COMPOSED

    assert all(unicodedata.normalize("NFC", k) == v for k, v in COMPOSED.items())
    assert not re.search(r"[A-Z]", "".join(COMPOSED.values()))
