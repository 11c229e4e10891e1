"""Every form of assignment that the lexer reads, texts that hold none, and texts built to slow it down."""

import time

import pytest

from movrec.llm import secrets

VALUE = "sK9xQ2mZ7vB4nL1pW8cT5rY3"
FORMS = [
    'os.environ["NAME"] = "VALUE"',
    'x["a"]["NAME"]="VALUE"',
    "x[0]['NAME'] = 'VALUE'",
    'NAME = """VALUE"""',
    "NAME = '''\n  VALUE\n'''",
    "NAME = r'VALUE'",
    "NAME = `VALUE`",
    "a: 1\nNAME: |\n  VALUE\nother: x",
    "deep:\n  NAME: >-\n    VALUE\n  other: x",
    'K = "VALUE"\nNAME = K',
    'K = "VALUE"\nNAME = f(K)',
    'K = "VALUE"\nNAME = f(1, g(K))',
    'K = "VALUE"\nNAME = f"x-{K}"',
    'K="VALUE"\nNAME=$K',
    'A = "VALUE"\nB = A\nNAME = B',
    'c["k1"] = "VALUE"\nNAME = c["k1"]',
    'NAME = os.getenv("K") or "VALUE"',
    'NAME = decode("VALUE")',
    'NAME = ("VALUE")',
    'NAME: str = "VALUE"',
    'var NAME string = "VALUE"',
    'set("NAME", "VALUE")',
    'props.put("NAME", "VALUE");',
    "- name: NAME\n  value: VALUE",
    '<add key="NAME" value="VALUE"/>',
    "<NAME>VALUE</NAME>",
    'run("login --NAME VALUE now")',
    "`NAME = 'VALUE'`",
    '```\nNAME = "VALUE"\n```',
    "https://h.example/p?NAME=VALUE&x=1",
    ':NAME => "VALUE"',
    'NAME := "VALUE"',
    'NAME == "VALUE"',
    '$NAME = "VALUE";',
    "don't stop; NAME = 'VALUE'",
    'he said "no; NAME = VALUE',
    'é 漢字 {"NAME": "VALUE"}',
]


def literals(text):
    return [(a, b) for k, a, b in secrets.find_spans(text) if k == "literal"]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("name", ["signing_key", "clientPassword", "DB_PASSPHRASE"])
def test_form(form, name):
    for before, after in (("", ""), ("Some words stand here: first.\n", "\nand here, as well\n")):
        text = before + form.replace("NAME", name).replace("VALUE", VALUE) + after
        at = text.index(VALUE)
        assert literals(text) == [(at, at + len(VALUE))]
        assert VALUE not in secrets.redact(text)
    plain = form.replace("NAME", "colour").replace("VALUE", VALUE)
    assert literals(plain) == []


@pytest.mark.parametrize("name", ["setSigningKey", "withPassword", "obj.setClientSecret"])
def test_setters(name):
    text = f'{name}("{VALUE}")'
    assert literals(text) == [(len(name) + 2, len(name) + 2 + len(VALUE))]
    assert literals(text.replace("set", "get").replace("with", "check")) == []


@pytest.mark.parametrize(
    "text",
    [
        'password = os.environ["DB_PASSWORD_2"]',
        'password = getenv("DB_PASSWORD_2")',
        'get_secret("prod/db/pass1")',
        'token = request.headers["X-Auth-Token2"]',
        'password = "change_me"',
        "password: ${ENV}",
        "The key: tomorrow at 12:30. It's fine; 'tis done = good.",
        "a `lone backtick and a \" lone quote",
        "The meeting (see below): results = good",
    ],
)
def test_clean(text):
    assert literals(text) == []


@pytest.mark.parametrize(
    "unit", ["a=f(", "a=[", "a=(", "x=f(y=", '"', "'", "`a", "`", '"\\', "`\\", "a:", 'a["x"]', 'a="x"+', '"""a', "a='", 'set("a",', "<a>", "a: |\n", "a=b[c]", "--a ", "a b ", "a-", "$"]
)
def test_long_texts_take_time_in_proportion(unit):
    """Ten times the text may take ten times as long, not a hundred times."""

    def seconds(n):
        begin = time.process_time()
        secrets.find_spans(unit * n + f'\nsigning_key = "{VALUE}"')
        return time.process_time() - begin

    assert seconds(20_000) < 25 * max(seconds(2_000), 0.02)
