"""Forms of assignments that the lexer reads."""

import time

import pytest

from sparkmart.llm import secrets

VALUE = "Zk81-pqLr77x"


@pytest.mark.parametrize(
    "line",
    [
        'api_key: str = "{}"',
        'const token: string = "{}"',
        "token?: string | undefined = '{}'",
        'password: Optional[str] = "{}"',
        'password: Dict[str, List[str]] = "{}"',
        'let secret: &\'static str = "{}";',
        'val password: kotlin.String? = "{}"',
        'key: "str" = 1\nclient_secret: "str" = "{}"',
        'config["db_password"] = "{}"',
        "os.environ['APP_TOKEN'] = '{}'",
        'settings["auth"]["secret"]: "{}"',
        'char password[] = "{}";',
        'var token string = "{}"',
        'Dim password As String = "{}"',
        'const std::string password = "{}";',
        'const char *password = "{}";',
        'token = b"{}"',
        'name = token = "{}"',
        'args: token="{}"',
    ],
)
def test_forms(line):
    text = "x = 1\n" + line.format(VALUE) + "\nend"
    place = text.index(VALUE)
    assert secrets.lexed_spans(text) == [(place, 3, place + len(VALUE))]


@pytest.mark.parametrize("value", ["739104826155", "correcthorsebattery", "QWJZKPMXVTRB"])
def test_literals_of_one_kind(value):
    assert secrets.lexed_spans(f'password = "{value}"') == [(12, 3, 12 + len(value))]


def test_typed_constants_are_propagated():
    text = f'START: str = "{VALUE}"\nvar other string = "{VALUE}"\npassword = START\nclient_secret = other'
    first, second = text.index(VALUE), text.rindex(VALUE)
    assert secrets.lexed_spans(text) == [(first, 4, first + len(VALUE)), (second, 4, second + len(VALUE))]


@pytest.mark.parametrize(
    "text",
    [
        'def login(password: str, token: string) -> None: x: str = "Zk81-pqLr77x"; token: str',
        'password = "aaaaaaaaaaaaaaaa"',
        'password = "changemechangeme"',
        "Note: the password is long; time: 12:30, a = b",
        'label: str = "Zk81-pqLr77x"',
        "credential: wordswithoutdigits",
    ],
)
def test_no_secret(text):
    assert secrets.lexed_spans(text) == []


def test_bare_values_keep_their_signs():
    text = "credential: abcd1234efgh=\npwd: abc12345=xyz9"
    assert [text[a:b] for a, _, b in secrets.lexed_spans(text)] == ["abcd1234efgh=", "abc12345=xyz9"]


def test_long_texts_take_time_in_proportion():
    start = time.monotonic()
    for text in ("a: b" * 50000, "var " * 50000 + "=", "x: [" * 50000 + "=", "a: b<" * 50000, "a: b | " * 50000, "a:" + " " * 200000, "a: " + "b" * 200000, "a." * 100000 + "= 1"):
        secrets.lexed_spans(text)
    assert time.monotonic() - start < 30
