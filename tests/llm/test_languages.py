"""Quality: prose in languages outside the lists of function words is kept."""

import itertools

import pytest

from timeline_engine.llm import quality_rules as Q

PROSE = {
    "Polish": "Wczoraj wieczorem poszliśmy razem nad rzekę, żeby zobaczyć zachód słońca. Było już chłodno, ale nikt nie narzekał. Dzieci zbierały kamienie i wrzucały je do wody, a starsi rozmawiali o pracy i podróżach. Kiedy zrobiło się ciemno, wróciliśmy do domu i zjedliśmy późną kolację.",
    "Russian": "Вчера вечером мы вместе пошли к реке, чтобы посмотреть на закат. Было уже прохладно, но никто не жаловался. Дети собирали камни и бросали их в воду, а взрослые говорили о работе и путешествиях. Когда стемнело, мы вернулись домой и поужинали.",
    "Greek": "Χθες το βράδυ πήγαμε μαζί στο ποτάμι για να δούμε το ηλιοβασίλεμα. Είχε ήδη κρύο, αλλά κανείς δεν παραπονέθηκε. Τα παιδιά μάζευαν πέτρες και τις πετούσαν στο νερό, ενώ οι μεγάλοι μιλούσαν για τη δουλειά και τα ταξίδια τους.",
    "Turkish": "Dün akşam gün batımını görmek için birlikte nehre gittik. Hava artık serindi ama kimse şikâyet etmedi. Çocuklar taş toplayıp suya attılar, büyükler ise iş ve yolculuklar hakkında konuştular. Hava kararınca eve dönüp geç bir yemek yedik.",
    "Italian": "Ieri sera siamo andati insieme al fiume per vedere il tramonto. Faceva già fresco, ma nessuno si lamentava. I bambini raccoglievano sassi e li gettavano nell'acqua, mentre gli adulti parlavano del lavoro e dei viaggi fatti quell'anno.",
    "Finnish": "Eilen illalla kävelimme yhdessä joelle katsomaan auringonlaskua. Oli jo viileää, mutta kukaan ei valittanut. Lapset keräsivät kiviä ja heittivät niitä veteen, kun taas aikuiset puhuivat työstä ja matkoista.",
}
JUNK = ["word### other$$$ third%%% " * 12, "a | b | c | d | e | f | g | h | i | j | k | l | m | n | o | p"]


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    more = [(-1 - k, t) for k, t in enumerate([*PROSE.values(), *JUNK])]
    out = Q.judge(docs.unionByName(spark.createDataFrame(more, "doc_id bigint, text string")))
    return {r.doc_id: r for r in out.where("doc_id < 0").collect()}


@pytest.mark.parametrize("k, language", list(enumerate(PROSE)))
def test_prose_of_other_languages_is_kept(judged, k, language):
    row = judged[-1 - k]
    assert row.kept and row.p_good > 0.9, language


@pytest.mark.parametrize("k", range(len(JUNK)))
def test_junk_is_not(judged, k):
    assert not judged[-1 - len(PROSE) - k].kept


def test_function_words_never_vote_against():
    k = [r[0] for r in Q.RULES].index("share of function words")
    for x in (0.0, 0.01, 0.05, 0.11):
        values = [None] * len(Q.RULES)
        values[k] = x
        assert Q.vote(values) == 0
    values[k] = 0.12
    assert Q.vote(values) == Q.GOOD * 3**k


def test_measures_equal_a_plain_count():
    words = ["a", "a#", "b", "|", "b", "b", "<c", "é$"]
    for n in range(1, 5):
        for some in itertools.islice(itertools.permutations(words, n), 60):
            value = dict(zip([r[0] for r in Q.RULES], Q.measure(" ".join(some), Q._class_tables(), frozenset())[1], strict=True))
            assert value["share of words without a symbol"] == pytest.approx(sum(not set(w) & set(Q.SYMBOLS) for w in some) / n)
            assert value["share of words equal to the word before"] == sum(x == y for x, y in itertools.pairwise(some)) / n
