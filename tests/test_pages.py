from ludoshelf.operators import html_facts
from tests.payloads import SCORE_HTML, landing_rows


def rows(spark, *bodies):
    return landing_rows(spark, [dict(app_id=n, body=b) for n, b in enumerate(bodies)])


def store(spark, body):
    return html_facts.store_facts(rows(spark, body), "app_id").first()


def scores(spark, *bodies):
    found = html_facts.score_facts(rows(spark, *bodies), "app_id").orderBy("app_id").collect()
    return [(r.critic_score, r.user_score, r.user_score_raw) for r in found]


def pair(header, value):
    return f'<span data-testid="global-score-value">{value}</span><div data-testid="global-score-header">{header}</div>'


def test_tags_keep_their_gaps(spark):
    html = '<div class="popular_tags x"><a class="app_tag">A</a><a class="app_tag">&nbsp;</a><p><a class="z app_tag">B <i>c</i></a></div><a class=app_tag>D</a>'
    assert [(t.name, t.rank, t.source) for t in store(spark, html).tags] == [("A", 1, "audience"), ("B c", 3, "audience")]


def test_matrix_of_the_first_table_only(spark):
    html = (
        "<table class='game_language_options'><tr><td>head</td></tr>"
        "<tr><td> <b>French</b> </td><td></td><td><div><span></span></div></td><td></td></tr>"
        "<tr><td></td><td></td><td></td><td></td></tr><tr><td>x</td><td></td><td></td></tr></table>"
        "<table class='game_language_options'><tr></tr><tr><td>No<td><td><td></tr></table>"
    )
    found = store(spark, html).language_matrix
    assert [(x.name, x.steam_language, x.interface, x.full_audio, x.subtitles) for x in found] == [
        ("French", "french", False, True, False)
    ]
    assert store(spark, "<p>none").language_matrix == [] and store(spark, "").tags == []


def test_text_in_scripts_is_no_markup(spark):
    html = '<script>var t="<div class=popular_tags><a class=app_tag>x</a>"</script><div class=popular_tags><a class=app_tag>y</a>'
    assert [t.name for t in store(spark, html).tags] == ["y"]


def test_score_blocks(spark):
    later = pair("metascore", "10") + pair("METASCORE", "91 of 100")
    uneven = pair("Metascore", "50") + '<div data-testid="global-score-header">User score</div>'
    got = scores(spark, SCORE_HTML, later, uneven, pair("User Score", "tbd"), pair("User score", "11"), pair("metascore", "101"))
    assert got == [(68, 8.3, "8.3"), (91, None, None), (50, None, None), (None, None, "tbd"), (None, None, "11"), (None, None, None)]


def test_json_ld_only_without_a_critic_score(spark):
    def script(content):
        return f'<script type="application/ld+json">{content}</script>'

    usable = script('{"aggregateRating": {"ratingValue": "88"}}')
    got = scores(
        spark,
        script("{broken") + script("[1]") + script('{"aggregateRating": 5}') + usable + script('{"aggregateRating": {"ratingValue": 1}}'),
        pair("Metascore", "70") + usable,
        script('{"aggregateRating": {"ratingValue": 188}}'),
        script('{"aggregateRating":\n {"ratingValue": 71.9}}'),
    )
    assert [g[0] for g in got] == [88, 70, None, 71]


def test_achievement_summary(spark):
    html = (
        '<div class="achieveRow"><div class="achieveTxt"><h3>A</h3></div><div class="achievePercent">10%</div></div>'
        '<div class="achieveRow HIDDEN"><div class="achieveTxt"><h3>B</h3></div></div>'
    )
    facts = html_facts.achievement_facts(rows(spark, html, ""), "app_id")
    got = html_facts.achievement_summary(facts, "app_id").orderBy("app_id").collect()
    assert [(r.achievements, r.hidden, r.avg_percent) for r in got] == [(2, 1, 10.0), (0, 0, None)]


def test_time_of_a_page_grows_with_its_blocks(spark):
    import time

    from ludoshelf.operators import html_facts

    def seconds(blocks):
        row = '<div class="achieveRow"><div class="achieveTxt"><h3>n</h3><h5>d</h5></div></div>'
        pages = spark.createDataFrame([(1, row * blocks)], "id long, body string")
        start = time.perf_counter()
        assert html_facts.achievement_facts(pages, "id").selectExpr("size(achievements) n").first().n == blocks
        return time.perf_counter() - start

    seconds(10)
    assert seconds(8000) < 12 * max(seconds(1000), 0.5)
