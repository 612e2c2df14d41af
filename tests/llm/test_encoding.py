import random
import time

import pytest

from cadenza.llm.encoding import PASSAGE_PAIRS, WRONG_FOR_UTF8, Plausibility, count_pairs, restore, restore_encoding

SCHEMA = "doc_id bigint, text string, chains int, lost string"
FRENCH = "L’été, déjà là — “garçon” où être naïf, crêpe brûlée à Noël."
RUSSIAN = "Ещё карандаш для школы, где перебирать орехи и чайник. Мы свистели — да."
SOUND = [
    "Près du château, la forêt était très calme ; « Noël » approchait. Où êtes-vous, mon garçon ? Ça va, bien sûr.",
    "C’est une crème brûlée déjà prête, à côté du théâtre — naïve idée. L’île, l’âne, le goûter, les élèves.",
    "Über die Brücke fährt der müde Bär; “schöne Grüße” aus München. Größe, Straße, für Öl.",
    "El niño pequeño comió jalapeños en la montaña; ¿dónde está el león? Mañana, corazón, también.",
    "Ещё один день прошёл: мы шли домой, где нас ждали чай и варенье. Для школы нужны карандаши и тетради.",
    "Она свистела и перебирала орехи — да, так было всегда. Мой чайник стоял над печью, под ним лежали дрова.",
    "Съешь же ещё этих мягких французских булок, да выпей чаю. Юля пришла поздно; моя сестра уже спала.",
    "В лесу родилась ёлочка, в лесу она росла. Зимой и летом стройная, зелёная была. Пришёл хороший друг.",
    "МЫ ШЛИ ДОМОЙ. ЕЩЁ ДЕНЬ. ÉCOLE, GARÇON, MÊME, ÜBER. № 7, 20 °C, ½ — “ok”… ‘so’.",
    "Ріg іn а саnvаs; Рісk а саrrоt. Пришёл трёх рёв, РЁВ",
    "dʒ ʌ m p ɹ ɪ n ɡ ɛ ɔ æ ʃ θ ð ŋ ə",
]
MODEL = Plausibility({k: 20 * n for k, n in count_pairs(SOUND).items()})


def _seen(text, written, seen):
    return "".join(chr(b) if not (c := bytes([b]).decode(seen, "ignore")) else c for b in text.encode(written))


@pytest.mark.parametrize("codec", WRONG_FOR_UTF8)
@pytest.mark.parametrize("text", [FRENCH, "jalapeño über größe", RUSSIAN])
def test_round_trip(codec, text):
    fixed, chains, lost = restore(_seen(text, "utf-8", codec), MODEL)
    assert fixed == text and chains and not lost


def test_without_counts():
    for codec in ("cp1252", "latin-1", "mac_roman", "cp437"):
        assert restore(_seen(FRENCH, "utf-8", codec))[0] == FRENCH
    assert restore(FRENCH) == (FRENCH, [], 0) and restore(RUSSIAN) == (RUSSIAN, [], 0)


def test_twice_in_places_and_other_alphabet():
    bad = FRENCH
    for _ in range(6):
        bad = _seen(bad, "utf-8", "latin-1")
    assert restore(bad, MODEL)[0] == FRENCH
    assert restore(_seen(_seen(FRENCH, "utf-8", "cp1252"), "utf-8", "mac_roman"), MODEL)[0] == FRENCH
    mixed = f"“Fine” été. caf{'é'.encode().decode('cp1252')} then."
    assert restore(mixed, MODEL)[0] == "“Fine” été. café then."
    assert restore(RUSSIAN.replace("—", "-").encode("cp1251").decode("latin-1"), MODEL)[0] == RUSSIAN.replace("—", "-")
    assert restore("m \xa0å s h …π …î …î m s …™ d …õ", MODEL)[0] == "m ʌ s h ɹ ɔ ɔ m s ɪ d ɛ"
    assert restore("the caf�", MODEL)[2] == 1


def test_double_byte_and_entities():
    assert restore("他们的学校很好".encode().decode("gbk", "ignore"), MODEL)[0] in ("他们的学校很好", "他们的学校很好".encode().decode("gbk", "ignore"))
    assert restore("你好世界".encode().decode("gbk"), MODEL)[0] == "你好世界"
    assert restore("caf&Atilde;&copy; d&eacute;j&agrave;", MODEL)[0].startswith("café")
    assert restore("d&eacute;j&agrave; AT&amp;T", MODEL) == ("d&eacute;j&agrave; AT&amp;T", [], 0)


@pytest.mark.parametrize("text", [
    FRENCH, RUSSIAN, "Ærø þörf Łódka", "20 °C № 7 «là» † ½ → ±3 12 €", "IRMÃ\nCORAÇÃO", "the саt sаt οn ѕоmе mаt", "dʒ ʌ ɹ ɛ æ ɪ", "日本語 текст", "ｗｉｄｅ　ｔｅｘｔ", "Рёбра, Ёж!", "AT&T &amp; co", "",
    "∑ αβγ ≤ ∞ ±½ °C", "ÀÉÎÕÜ ÄÖÜ", "Ріkаpаkа аu mосhа. Сіrсlеlіkе еchоѕіdе, саnvаѕѕіdе", "а cat а mat а rat а hat а bat", "Il dit « Noël », puis « été ».",
])
def test_sound_texts(text):
    assert restore(text, MODEL) == (text, [], 0)


def test_a_garbled_sign_leaves_the_rest_alone():
    assert restore("Les cafés « Noël » Â£ 5, « été »", MODEL)[0] in ("Les cafés « Noël » £ 5, « été »", "Les cafés « Noël » Â£ 5, « été »")


@pytest.mark.parametrize("seen,written", PASSAGE_PAIRS)
def test_cyrillic_code_pages(seen, written):
    text = "Ещё карандаш для школы, где перебирать орехи и чайник. Я пришёл домой поздно; моя сестра Юля уже спала. Мы свистели."
    fixed, chains, lost = restore(_seen(text, written, seen), MODEL)
    assert fixed == text and chains and not lost


def test_passages_in_sound_text():
    sound = "Река течёт под мостом, и над ней кружит птица."
    bad = _seen("Для печенье нужен сахар", "koi8_r", "cp1251")
    assert bad.startswith("дМС РЕЮЕОШЕ")
    assert restore(f"{sound} {bad}. {sound}", MODEL)[0] == f"{sound} Для печенье нужен сахар. {sound}"
    assert restore(f"Teacher: {bad}\nThe end", MODEL)[0] == "Teacher: Для печенье нужен сахар\nThe end"


@pytest.mark.parametrize("text", [
    "МЧС, МВД, ФСБ, ЮНЕСКО, ЦСКА, НХЛ, ЖКХ, ЭВМ, ЧП", "Він читає книгу і їсть яблуко. Її ґанок. «Так» — є! Це світ.", "България, съм път към върха, ъгъл. Къща, мъж, дъжд.",
    "«Да», — сказал он. №5, 20°С, § 12; 5 € ±3", "эхо аэропорт вьюга подъезд жюри", "═══ ║ да ║ ═══ │ ├──┼──", "à É ü", "Frоm dеsеrtѕіdе nеаr роnуѕ",
])
def test_sound_texts_of_other_kinds(text):
    assert restore(text, MODEL) == (text, [], 0)


def test_recall_and_precision_on_planted_passages():
    """Passages of sound text garbled at random, one in four texts: all found and restored but a few, nothing else touched."""
    rng = random.Random(7)
    words = [w for t in SOUND[:8] for w in t.split()]
    planted = found = right = false = 0
    for k in range(800):
        t = [rng.choice(words) for _ in range(30)]
        text = " ".join(t)
        if k % 4:
            false += restore(text, MODEL)[1] != []
            continue
        a, codec = rng.randrange(20), rng.choice(("cp1252", "latin-1", "mac_roman", "cp437", "cp1251"))
        part = " ".join(t[a : a + 10])
        if part.isascii():
            continue
        fixed, chains, _ = restore(" ".join([*t[:a], _seen(part, "utf-8", codec), *t[a + 10 :]]), MODEL)
        planted, found, right = planted + 1, found + bool(chains), right + (fixed == text)
    assert planted > 150 and found == planted and right >= 0.95 * planted and false == 0


def test_search_ends_on_long_runs():
    t = time.time()
    restore("ÃÂÐÑ×" * 400 + " " + "é" * 5000, MODEL)
    assert time.time() - t < 20


def test_rows(spark):
    rows = [(1, "plain"), (2, None), (3, ""), (4, "cafÃ©"), (4, "cafÃ©"), (5, "lost �"), (6, "x" * 100_000 + " dÃ©jÃ\xa0"), (7, RUSSIAN), (8, "le café déjà")]
    got = restore_encoding(spark.createDataFrame([(*r, 1, "l") for r in rows], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["restored_affected"]) for r in got) == [(1, False), (2, False), (3, False), (4, True), (4, True), (5, True), (6, True), (7, False), (8, False)]
    by = {r["doc_id"]: r["restored_text"] for r in got}
    assert by[4] == "café" and by[2] is None and by[6].endswith(" déjà") and by[7] == RUSSIAN
    assert restore_encoding(spark.createDataFrame([], SCHEMA)).count() == 0
