"""Keys and search words: the agreed cases."""

import html

import pytest

from regspark.functions import text as tx

#: The agreed cases of join keys and of search words, all of them.
KEYS = [
    ("3M DO BRASIL LTDA.", "3mdobrasilltda"),
    ("  Nestlé  S/A  ", "nestlesa"),
    ("L'ORÉAL", "loreal"),
    ("FÁBRICA – SUL", "fabricasul"),
    ("ERVAS & ESSÊNCIAS", "ervasessencias"),
    ("Dr. Müller GmbH & Co. KG", "drmullergmbhcokg"),
    ("B.BRAUN", "bbraun"),
    ("Johnson’s", "johnsons"),
    ("ETHICON ENDO-SURGERY, INC.", "ethiconendosurgeryinc"),
    ("3ª Dimensão Nº 2", "3adimensaono2"),
    ("Vitamina C™ 2²", "vitaminactm22"),
    ("Ñandú", "nandu"),
    ("Straße", "strae"),
    ("ŁÓDŹ", "odz"),
    ("Øresund", "resund"),
    ("株式会社 Kabushiki", "kabushiki"),
    ("POLAR FIX INDUSTRIA", "polarfixindustria"),
    ("Polar Fix Indústria", "polarfixindustria"),
    ("COOK (EUROPE) A/S", "cookeuropeas"),
    ("Zhejiang  Orient\tGene", "zhejiangorientgene"),
    ("", ""),
]
WORDS = [
    ("SHAMPOO ANTICASPA", ["shampoo", "anticaspa"]),
    ("Shampoo Anticaspa", ["shampoo", "anticaspa"]),
    ("LOÇÃO HIDRATANTE", ["locao", "hidratante"]),
    ("Óleo de Coco", ["oleo", "coco"]),
    ("ÁGUA MICELAR ÜBER", ["agua", "micelar", "uber"]),
    ("ESPAÑA", ["espana"]),
    ("PROTETOR SOLAR FPS50", ["protetor", "solar", "fps50"]),
    ("PROTETOR SOLAR FPS 50", ["protetor", "solar", "fps", "50"]),
    ("VITAMINA B12", ["vitamina", "b12"]),
    ("CREME P/ MÃOS", ["creme", "maos"]),
    ("SABONETE DE ERVAS PARA BANHO COM MEL", ["sabonete", "ervas", "banho", "mel"]),
    ("DE PARA COM", []),
    ("A B C", []),
    ("", []),
    ("GEL GEL FIXADOR", ["gel", "fixador"]),
    ("ERVAS & ESSÊNCIAS", ["ervas", "essencias"]),
    ("ERVAS &AMP; ESSENCIAS", ["ervas", "amp", "essencias"]),
    ("L'ORÉAL PARIS", ["loreal", "paris"]),
    ("L’ORÉAL PARIS", ["loreal", "paris"]),
    ("JOHNSON'S BABY", ["johnsons", "baby"]),
    ("LIFENATU`S", ["lifenatus"]),
    ("D´ÁGUA", ["dagua"]),
    ("ANTI-QUEDA", ["anti", "queda", "antiqueda"]),
    ("SHAMPOO 2-EM-1", ["shampoo", "2em1"]),
    ("PÓS-SOL BB-CREAM", ["pos", "sol", "bb", "cream", "possol", "bbcream"]),
    ("ANTI - QUEDA", ["anti", "queda"]),
    ("2ª GERAÇÃO", ["2a", "geracao"]),
    ("Nº 7", ["no"]),
    ("AREA 5M²", ["area", "5m2"]),
    ("ﬁNO", ["fino"]),
    ("ＳＨＡＭＰＯＯ", ["shampoo"]),
    ("STRAßE", ["stra"]),
    ("SØREN", ["ren"]),
    ("ÆON", ["on"]),
    ("\u0017\u0010\u0016\u0018VITORIA FACE", ["vitoria", "face"]),
    ("CREME  CORPO", ["creme", "corpo"]),
    ("1,5L 200ML 0.5%", ["5l", "200ml"]),
    ("  ESPAÇOS   EXTRAS  ", ["espacos", "extras"]),
    ("КРЕМ CREME", ["creme"]),
    ("İPEK", ["ipek"]),
]
#: Our own: characters that come apart into several.
MORE_WORDS = [("5㎏ Ⅷ", ["5kg", "viii"]), ("𝐀𝐁 ½L", ["ab", "2l"]), ("PÃO-DE-Ló d-a", ["pao", "lo", "paodelo"])]


def test_keys(spark):
    got = spark.createDataFrame(KEYS, "a string, b string").select("a", tx.key("a").alias("k"), "b").collect()
    assert [(r["a"], r["k"]) for r in got] == KEYS


def test_words(spark):
    cases = WORDS + MORE_WORDS
    got = spark.createDataFrame(cases, "a string, b array<string>").select("a", tx.words("a").alias("w")).collect()
    assert [(r["a"], r["w"]) for r in got] == cases


@pytest.mark.parametrize(("raw", "want"), [(" x \n", "x"), (" \t", None), (None, None)])
def test_strip(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "a string").select(tx.strip_or_null("a")).head()[0] == want


def test_windows_bytes_and_entities(spark):
    raw = spark.createDataFrame([(bytearray(b"CORA\xc7\xc3O \x96 5\x92 MARK\x99 \x81"),)], "b binary")
    assert raw.select(tx.decode_cp1252("b")).head()[0] == "CORAÇÃO – 5’ MARK™ \x81"
    rows = [("Tom &amp; D&apos;Or &quot;Y&quot;; &#233;&#xE9;",), ("R&notícia & D&B &lt &#12a; &#x; &1;",), (None,)]
    assert [r[0] for r in spark.createDataFrame(rows, "a string").select(tx.unescape("a")).collect()] == ["Tom & D'Or \"Y\"; éé", "R&notícia & D&B &lt &#12a; &#x; &1;", None]


def test_entities_as_html_has_them_without_python(spark):
    names = [n.rstrip(";") for n in html.entities.html5]
    cases = [f"a&{n};b" for n in names] + [f"&{n}more;" for n in tx.WITHOUT_SEMICOLON] + [f"&Q{n};" for n in tx.WITHOUT_SEMICOLON]
    numbers = [*range(0x300), *range(0xD7FE, 0xE002), *range(0xFDCE, 0xFDF2), 0xFEFF, *range(0xFFFC, 0x10002), 0x1F600, *range(0x1FFFC, 0x20002), *range(0x10FFFC, 0x110002), 2**31, 2**64]
    cases += [e for n in numbers for e in (f"&#{n};", f"&#x{n:x};", f"&#X00{n:X};")]
    df = spark.createDataFrame([(c,) for c in cases], "a string").select("a", tx.unescape("a").alias("b"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert [(r["a"], r["b"]) for r in df.collect()] == [(c, html.unescape(c)) for c in cases]
    more = [("&amp;lt; &amp;amp;", "&lt; &amp;"), ("&&amp;;&;", "&&;&;"), ("&é; &copy é;", "&é; &copy é;"), ("&#" + "9" * 5000 + ";", "�"), ("", "")]
    assert [r["b"] for r in spark.createDataFrame(more, "a string, b string").select(tx.unescape("a").alias("b")).collect()] == [b for _, b in more]
