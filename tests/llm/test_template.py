"""The template language: parsing, folding and sandbox."""

import pytest

from logweir.llm.template import TemplateError, compile_template, fold_body, parse, Text


def render(source, **values):
    return compile_template(source)(values)[0]


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("a{{ 1 + 2 * 3 }}b", "a7b"),
        ("{{ 'x' ~ 1 ~ none ~ true }}", "x1true"),
        ("{{ -3 + 5 }}{{ 7 % 4 }}", "23"),
        ("{% if 1 < 2 and not false %}y{% else %}n{% endif %}", "y"),
        ("{% if a == 'q' %}1{% elif a in ['x', 'y'] %}2{% else %}3{% endif %}", "2"),
        ("{% for i in items %}{{ loop.index }}{{ i.k }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"),
        ("{% for i in none %}x{% else %}empty{% endfor %}", "empty"),
        ("{% set z = a | upper %}{{ z }}{{ items | length }}", "X2"),
        ("  {%- if true -%}  t  {%- endif -%}  ", "t"),
        ("{# note #}{{ 'a\\n\\'b' }}", "a\n'b"),
        ("{{ items[0]['k'] }}{{ items[9] }}{{ missing.deep.er }}", "p"),
        ("{{ missing | default('d') }}{{ ' t ' | trim }}", "dt"),
        ("{{ [1, 2] + [a] | join('-') }}", None),
        ("{{ ([1, 2] + [a]) | join('-') }}", "1-2-x"),
        ("{{ 'is' not in a }}", "true"),
    ],
)
def test_render(source, wanted):
    values = {"a": "x", "items": [{"k": "p"}, {"k": "q"}]}
    if wanted is None:
        with pytest.raises(TemplateError):
            render(source, **values)
    else:
        assert render(source, **values) == wanted


def test_generation_spans():
    text, spans = compile_template("é{% for x in l %}<{% generation %}{{ x }}{% endgeneration %}>{% endfor %}")(
        {"l": ["ab", "", "c"]}
    )
    assert text == "é<ab><><c>"
    assert [text[a:b] for a, b in spans] == ["ab", "", "c"]


def test_constants_are_folded():
    source = "a{{ 'b' | upper }}{% if 1 == 2 %}no{% else %}c{% endif %}{{ 'd' ~ 1 }}"
    assert fold_body(parse(source)) == (Text("aBcd1"),)


@pytest.mark.parametrize(
    "source",
    ["{% if x %}", "{% bad %}", "{{ x | nofilter }}", "{{ }}", "{{ f(x) }}", "{{ 'open }}", "{% for x %}{% endfor %}",
     "{{ a b }}", "{{ [1, }}"],
)
def test_errors(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_sandbox_reads_only_keys():
    class Secret:
        key = "secret"

    values = {"s": Secret(), "d": {"a": 1}, "t": "text"}
    source = "[{{ s.key }}{{ s.__class__ }}{{ d.__class__ }}{{ d.keys }}{{ t.upper }}{{ t['__class__'] }}]"
    assert render(source, **values) == "[]"
    with pytest.raises(TemplateError):
        render("{% for x in t %}{% endfor %}", **values)
