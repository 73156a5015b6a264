import pytest

from textloom.functions.snowball import french, german, spanish
from textloom.functions.stemmer import porter2
from textloom.operators import tokens

# Published word and stem pairs.
PAIRS = """
consign consign  consigned consign  consigning consign  consignment consign  consistency consist
consistently consist  consists consist  consolation consol  consolatory consolatori  consolidate consolid
consolingly consol  consonant conson  conspicuously conspicu  conspiracy conspiraci  conspirators conspir
conspiring conspir  constable constabl  constancy constanc  constant constant  knackeries knackeri
knavish knavish  kneaded knead  knees knee  knife knife  knightly knight  knitted knit  knitting knit
knives knive  knocker knocker  knots knot  skies sky  dying die  news news  sky sky  generate generat
generously generous  communism communism  arsenal arsenal  inning inning  proceed proceed  exceeding exceed
hopping hop  hoping hope  bed bed  luxuriating luxuri  falling fall  cries cri  ties tie  gas gas
this this  gaps gap  kiwis kiwi  caresses caress  happy happi  say say  by by  enjoy enjoy  relational relat
conditional condit  rational ration  digitizer digit  feudalism feudal  hopefulness hope  sensitivity sensit
analogical analog  replacement replac  adoption adopt  probate probat  rate rate  controlling control
roll roll  quickly quick  agreed agre  fed fed  youth youth  boyish boyish  at at  i i
""".split()


@pytest.mark.parametrize("word,stem", list(zip(PAIRS[::2], PAIRS[1::2])))
def test_published_pairs(word, stem):
    assert porter2(word) == stem


def test_apostrophes():
    assert [porter2(w) for w in ["dog's", "dogs'", "'tis", "boss's'"]] == ["dog", "dog", "tis", "boss"]


def test_rows_get_the_stem_of_their_word(spark):
    rows = spark.createDataFrame([("running", 1), ("runs", 1), ("runs", 2), ("x", 2)], "word string, doc_id long")
    got = sorted(tuple(r) for r in tokens.stem_words(rows).select("word", "doc_id", "stem").collect())
    assert got == [("running", 1, "run"), ("runs", 1, "run"), ("runs", 2, "run"), ("x", 2, "x")]


GERMAN = (
    "aufeinander aufeinand|kategorie kategori|kategorien kategori|kater kat|katers kat|häuser haus|häusern haus|hauses haus"
    "|straße strass|kenntnisse kenntnis|größten grosst|bayern bay|freundlichkeit freundlich|einigung einig|möglichkeiten moglich"
    "|politisch polit|kindheit kindheit|schönheit schonheit|beleidigung beleid|wichtig wichtig|feuer feu|läuft lauft"
)
FRENCH = (
    "continu continu|continua continu|continuait continu|continuant continu|continuation continu|continue continu"
    "|continuel continuel|continuelle continuel|continuellement continuel|majestueusement majestu|majestueux majestu"
    "|majorité major|malade malad|malheureusement malheur|malheureux malheur|maisons maison|chevaux cheval|eaux eau"
    "|activité activ|rapidement rapid|constamment const|évidemment évident|logique logiqu|finissait fin|nation nation|lumière lumi"
    "|parlerions parl|mangeait mang|premier premi|ancienne ancien|solution solut|différence différent"
)
SPANISH = (
    "chicana chican|chicano chican|chicas chic|chicharrones chicharron|chico chic|torá tor|tórax torax|toreado tor"
    "|toreándolo tor|toreros torer|tormentas torment|tornado torn|torneos torne|torpeza torpez|torres torr"
    "|rápidamente rapid|felicidad felic|nacionalidades nacional|biología biolog|solución solucion|revolución revolu|presencia presenci"
    "|siguen sig|pague pag|huyendo huyend|construyendo constru|cantándoselo cant|cantaríamos cant|nación nacion|activos activ"
)


@pytest.mark.parametrize("rule, pairs", [(german, GERMAN), (french, FRENCH), (spanish, SPANISH)])
def test_other_languages_by_rule(rule, pairs):
    wrong = [(w, rule(w), s) for w, s in (pair.split() for pair in pairs.split("|")) if rule(w) != s]
    assert not wrong
    assert rule("") == "" and [rule(w) for w in ("a", "123", "qu")] == ["a", "123", "qu"]


def test_rows_of_every_language(spark):
    rows = [(1, "de", "Häuser, häuser"), (2, "fr", "chevaux été"), (3, "es", "chicas"), (4, "en", "running"), (5, "it", "case"), (6, None, "case")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {(r["lang"], r["word"]): (r["stem"], r["n"]) for r in tokens.stems_by_language(docs).collect()}
    assert got == {
        ("de", "häuser"): ("haus", 2), ("fr", "chevaux"): ("cheval", 1), ("fr", "été"): ("été", 1), ("es", "chicas"): ("chic", 1),
        ("en", "running"): ("run", 1), ("it", "case"): ("case", 1), (None, "case"): ("case", 1),
    }
    words = spark.createDataFrame([("chicas", 1)], "word string, doc_id long")
    assert [r["stem"] for r in tokens.stem_words(words, "spanish").collect()] == ["chic"]


def test_languages_without_rules_need_a_table(spark):
    rows = spark.createDataFrame([("chats", 1), ("le", 1)], "word string, doc_id long")
    with pytest.raises(ValueError, match="latin"):
        tokens.stem_words(rows, "latin")
    table = spark.createDataFrame([("chats", "chat"), ("chats", "chatt"), ("autre", "autr")], "word string, stem string")
    got = {r["word"]: r["stem"] for r in tokens.stem_words(rows, "french", table).collect()}
    assert got == {"chats": "chat", "le": "le"}
    blank = spark.createDataFrame([("chats", "le chat")], "word string, stem string")
    with pytest.raises(ValueError, match="blank"):
        tokens.stem_words(rows, "french", blank)
