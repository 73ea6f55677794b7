"""The lexer on literals of every form, and against texts whose statements are known as they are made."""

import random
import time

import pytest

from sparkmart.llm import secrets

VALUE = "Zk81-pqLr77x"


@pytest.mark.parametrize(
    "text, found",
    [
        (r'password = "Zk81\"pqLr77x"', [r"Zk81\"pqLr77x"]),
        ('password = """Zk81-pqLr77x"""', [VALUE]),
        ("password = '''Zk81-pqLr77x'''", [VALUE]),
        ("const token = `Zk81-pqLr77x`;", [VALUE]),
        ('secret = "Zk81-pq" + "Lr77x-9"', ['Zk81-pq" + "Lr77x-9']),
        ('secret = ("Zk81-pq" +\n    "Lr77x-9")', ['Zk81-pq" +\n    "Lr77x-9']),
        ("<password>Zk81-pqLr77x</password>", [VALUE]),
        ('password =\n    "Zk81-pqLr77x"', [VALUE]),
        ('password = \\\n    "Zk81-pqLr77x"', [VALUE]),
        ('tokens = ["Zk81-pqLr77x", "Ab29+rsTu55y"]\nname = "Cd38-tuVw66z"', [VALUE, "Ab29+rsTu55y"]),
        ('x = cfg.get("db_password", "Zk81-pqLr77x")', [VALUE]),
        ('props.setProperty("api.token", "Zk81-pqLr77x");', [VALUE]),
        ('mypassword = "Zk81-pqLr77x"', [VALUE]),
        ('userpwd = "Zk81-pqLr77x"', [VALUE]),
        ('PGPWD="Zk81-pqLr77x"', [VALUE]),
        ('credential = "Qx7secret9Lm2"', ["Qx7secret9Lm2"]),
        ('a = "Zk81-pqLr77x"\na = f()\npwd = a', []),
        ('a = "Zk81-pqLr77x"\nif a == b: pwd = a', [VALUE]),
        ('password = "your-api-key-1234"', []),
        ('password = "my-secret-password"', []),
        ('password = "Zk81-pqLr77x', []),  # not closed
        ('label = get("colour", "Zk81-pqLr77x")', []),
        ("<label>Zk81-pqLr77x</label>", []),
        ("", []),
    ],
)
def test_forms(text, found):
    assert [text[a:b] for a, _, b in secrets.lexed_spans(text)] == found


def test_known_statements():
    """Random programs: what each statement does to the names is followed by a table, without reading the text."""
    rng = random.Random(7)
    sensitive, plain = ["password", "db_secret", "authToken", "userpwd"], ["label", "colour", "size_of", "title"]
    for _ in range(300):
        text, held, wanted = "", {}, []
        for _ in range(rng.randrange(1, 15)):
            name, action = rng.choice(sensitive + plain), rng.choice(["quote", "joined", "name", "call", "prose", "json"])
            word = "".join(rng.choices("abcdefgh", k=4)) + "-" + "".join(rng.choices("JKLMNP", k=4)) + "".join(rng.choices("23456789", k=4))
            place = None
            if action == "name" and held:
                other = rng.choice(sorted(held))
                text += f"{name} = {other}\n"
                place = (*held[other], 4)
            elif action == "call":
                text += f"{name} = f(x)\n"
                held.pop(name, None)
            elif action == "joined":
                begin = len(text) + len(name) + 4
                text += f'{name} = "{word[:5]}" + "{word[5:]}";\n'
                place = (begin, begin + len(word) + 5, 3)
            elif action == "prose":
                text += "It is said, and more than once.\n"
            else:
                before, after = ('"{}": "', '",\n') if action == "json" else ("{} = '", "'\n")
                begin = len(text) + len(before.format(name))
                text += before.format(name) + word + after
                place = (begin, begin + len(word), 3)
            if place:
                held[name] = place[:2]
                if name in sensitive:
                    wanted.append((place[0], place[2], place[1]))
        assert secrets.lexed_spans(text) == sorted(set(wanted)), text


def test_time_grows_with_the_text_alone():
    start = time.monotonic()
    for part in ('a="""', "a='''", 'a="\\', "a=`", 'a = "b" + ', 'a = ["b", ', '("a", ', "<a>b", 'a = (\n', 'a =\n', "a = \\\n", "a" , "+ \"b\"", ", 'x'"):
        secrets.lexed_spans(part * 40000)
        secrets.lexed_spans("a = " + part * 40000)
    assert time.monotonic() - start < 60
