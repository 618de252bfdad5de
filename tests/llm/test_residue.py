"""Residue: cases and no cases, cells, odd inputs."""

import pytest

from strandloom.llm import residue as r

YES = [
    "Oops! We can't find that notebook. It may have been moved or deleted.",
    "504 Gateway Timeout",
    "Loading...\n\nIf nothing happens, allow scripts and reload.",
    "このノートブックを表示するには JavaScript を有効にしてください。",
    "<noscript>The viewer needs JavaScript to run.</noscript>",
    "# {{ title }}\n\nSome words of its own stand here and go on.",
    "We keep 15 counts <INSERT contact> and load the others.",
    "- [figureCaption goes here]",
    "Prepared by _____ (author) on %%version%%.",
    "Intro text.\n\nSample text.\n\nMore.",
    "Sedet minuret pellis amarit lorem cusum umbrate sante.",
    "ID 7\n{\"error\": {\"code\": 429, \"message\": \"Too Many Requests\"}}",
    "TODO: fill in this section",
    "blah blah blah, blah blah blah",
    "Welcome to ${courseName}!",
]
NO = [
    'When the server answers "404 Not Found" we wait and ask again.',
    "The map runs with scripts switched off too; only zooming needs them.",
    "Widgets need JavaScript in the front end; here we use plain tables.",
    "In the page template, write `{{ institution }}` where the value should appear.",
    r"The loss is $\frac{{a}}{{b}} + \sum_{i} x_{i}$.",
    "TODO for next week: split the bus delays by count as well.",
    'As sample input we split the words "lorem ipsum dolor" into pieces and count them.',
    'A cell with "TBD" or "xxx" marks an unknown flow; we drop those rows.',
    "Set `<dataset>` in the config before you run the next cell.",
    "Error 404 was the most common reply in glacier photos: 5 of 90 calls.",
    "",
    "   ",
]


@pytest.mark.parametrize("text", YES)
def test_residue(text):
    assert r.is_residue(text)


@pytest.mark.parametrize("text", NO)
def test_no_residue(text):
    assert not r.is_residue(text)


@pytest.mark.parametrize(
    "text",
    [
        "By {{ user.name | upper }} of the group.", "About {{ data['title'] }} in short.", "Written by {{ _name }} here.", "Part ${1} begins.", "The plan of %TITLE% begins.", "Made by <AUTHOR NAME> in May.", "# [PROJECT TITLE]",
        "We thank {{ the_institution_that_gave_the_money_for_this_long_work }}.", "Dear <%= user['first name'] %>, welcome.", "(insert a longer description of the collected tables, with their dates and their places)",
        "Pagina non trovata.", "Halaman tidak ditemukan", "페이지를 찾을 수 없습니다.", "Nie znaleziono strony",
        "Vestibulum rutrum mattis faucibus ornatum pretium ligulam dictumst.",
    ],
)
def test_wordings_not_listed(text):
    assert r.is_residue(text)


@pytest.mark.parametrize(
    "text",
    ["The model reads [CLS] and [MASK] first.", "<TITLE>Rivers</TITLE>", "See [TITLE](a.html) for more.", "Set `%TITLE%` there.", "Let ${1}/{2}$ be half.", "We saw 5% of A and 7% of B.", "Mus musculus and Rattus norvegicus are kept.", "Write [[1, 2], [3, 4]] as rows."],
)
def test_no_wordings_alike(text):
    assert not r.is_residue(text)


#: Written without regard to the phrase rules, most of them taken from pages any reader has met.
OTHER_YES = ["페이지를 찾을 수 없습니다","Pagina non trovata","Nie znaleziono strony","Sayfa bulunamadı","الصفحة غير موجودة","*|FNAME|*","Dear [FIRST_NAME], welcome.","Welcome to $PROJECT_NAME$.","Error establishing a database connection","Cupcake ipsum dolor sit amet gummies tiramisu marshmallow.","Vivamus vestibulum curabitur pellentesque maecenas phasellus.","Your browser is not supported","404 Not Found","Oops! That page can't be found.","Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen.","Lorem ipsum dolor sit amet, consectetur adipiscing elit.","We're sorry, but something went wrong.","This site can't be reached","Veuillez activer JavaScript pour continuer.","ページが見つかりませんでした。","您访问的页面不存在","Страница не найдена","Hello {{ first_name }}!","Access Denied","Sidan kunde inte hittas","A página solicitada não foi encontrada.","Please enable cookies.","[Insert your conclusion here]","Your text here","Trang bạn yêu cầu không tìm thấy","Halaman tidak ditemukan","Δεν βρέθηκε η σελίδα","Please wait while we check your browser","502 Bad Gateway nginx","Add your description here.","Tu texto aquí","Hier steht Ihr Text."]
OTHER_NO = ["# Home","## Help","# Browse","$x^{{n}}$","f((x))","See [[Linear Regression]] for more.","cat <<EOF>> file","We got x.\nWe got x.\nWe got x.","The results are not available for 1907, so we left them out of the fit.","We drop rows whose sensor could not be reached during the storm.","An error occurred in 3 % of all trials, mostly at night.","The dataset has been moved to a new server by the museum.","He said «Le Petit Prince» is short.","Use df.loc[name] to pick a row.","The model can be found in section 3.","This page shows how to fit a line to the data.","Enable the filter to smooth the curve.","The text of the letter is short.","Dolor and calor are Latin words.","Requests timed out more often in winter, see the plot below.","Each table shows one month of data.","TODO: compare with the 1990 census."]


@pytest.mark.parametrize("text", OTHER_YES)
def test_residue_in_many_languages(text):
    assert r.is_residue(text)


@pytest.mark.parametrize("text", OTHER_NO)
def test_own_words_are_no_residue(text):
    assert not r.is_residue(text)


def test_coverage_counts_letters_of_residue_sentences(spark):
    df = spark.createDataFrame([(1, "Our own words.\n404 Not Found", None, None), (2, "Our own words.", None, None), (3, None, None, None)], "doc_id long, text string, cell_kinds array<string>, cell_starts array<long>")
    assert [tuple(x) for x in r.marks(df).orderBy("doc_id").collect()] == [(1, 11, 22), (2, 0, 11), (3, 0, 0)]


def test_kept_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, "Our own words.", None, None, "a", 14), (2, "404 Not Found", None, None, "a", 13), (3, None, None, None, None, None)], "doc_id long, text string, cell_kinds array<string>, cell_starts array<long>, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(x["doc_id"] for x in r.kept(spark, str(tmp_path)).collect()) == [1, 3]


def test_cells_and_odd_rows(spark):
    bad = "404 Not Found"
    long = "plain words. " * 50000 + "\n\n" + bad
    df = spark.createDataFrame(
        [
            (1, "words\n" + bad, ["text", "code"], [0, 6], "x"), (2, bad, ["output"], [0], "x"), (3, bad, ["text"], [0], "x"), (4, bad, None, None, "x"), (5, None, None, None, None), (6, " \n", ["text"], [0], ""),
            (7, "ab", ["text", "text"], [None, 99], ""), (8, long, None, None, ""), (3, bad, ["text"], [0], "x"), (9, bad, [], [], "x"),
        ],
        "doc_id long, text string, cell_kinds array<string>, cell_starts array<long>, residue string",
    )
    got = sorted((x["doc_id"], x["residue"]) for x in r.flagged(df).collect())
    assert got == [(1, False), (2, False), (3, True), (3, True), (4, True), (5, False), (6, False), (7, False), (8, True), (9, True)]
    assert r.flagged(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["x" * 5000 + "y", "xxx " * 3000 + "q", "_" * 20000, "`" * 20001, "{{" * 9000, "blah " * 3000 + "1", "$" * 9999 + "\\", "a%%" * 5000])
def test_awkward_texts_take_no_longer_than_their_length(text):
    import time

    began = time.time()
    r.is_residue(text)
    assert time.time() - began < 2


@pytest.mark.parametrize("text", ["404 not found. Please try again later, ", "404 not found ", "plain words and more of it. "])
def test_long_cells_take_linear_time(text):
    import time

    r.is_residue(text)
    took = []
    for n in (1 << 17, 1 << 20):
        began = time.time()
        r.is_residue(text * (n // len(text)))
        took.append(time.time() - began)
    assert took[1] < 24 * took[0] + 0.2
