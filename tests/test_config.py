import json

import pytest

from changelake.config import ConfigError, expand, load

CASES = [
    ("${V}", {"V": "x"}, "x"),
    ("$V", {"V": "x"}, "x"),
    ("${V}", {}, ""),
    ("$V", {}, ""),
    ("${V:-d}", {}, "d"),
    ("${V:-d}", {"V": ""}, "d"),
    ("${V:-d}", {"V": "x"}, "x"),
    ("${V:-}", {}, ""),
    ("${V:?must}", {"V": "x"}, "x"),
    ("a ${V} b ${W:-w}", {"V": "1"}, "a 1 b w"),
    ("plain text", {}, "plain text"),
    ("${MY_VAR_2}", {"MY_VAR_2": "y"}, "y"),
    ("${V:-http://h:80/p?q=1}", {}, "http://h:80/p?q=1"),
    ("host: ${H:-localhost}\nport: ${P:-3306}\n", {"P": "1"}, "host: localhost\nport: 1\n"),
    ("end $V", {"V": "z"}, "end z"),
    ("$U@$H", {"U": "u", "H": "h"}, "u@h"),
    ("${U}${H}", {"U": "u", "H": "h"}, "uh"),
    ("costs $100", {}, "costs $100"),
    ("${UNCLOSED", {}, "${UNCLOSED"),
    ("${}", {}, "${}"),
]


@pytest.mark.parametrize(("text", "env", "want"), CASES)
def test_expand(text, env, want):
    assert expand(text, env) == want


@pytest.mark.parametrize(("text", "env", "part"), [("${V:?is needed}", {}, "is needed"), ("${V:?is needed}", {"V": ""}, "is needed"), ("${V:?}", {}, "V"), ("${A:?first} ${B:?second}", {}, "first")])
def test_required(text, env, part):
    with pytest.raises(ConfigError, match=part):
        expand(text, env)


def test_load_and_validate():
    good = {"source_path": "/in", "target_path": "${T:-/out}", "pipeline": {"batch_size": 7}, "filter": {"include_patterns": ["^shop"]}}
    c = load(json.dumps(good), {})
    assert c.target_path == "/out" and c.pipeline.batch_size == 7 and c.filter.accepts("shop", "x") and not c.filter.accepts("other", "x")
    for bad in ({"source_path": "/in"}, good | {"pipeline": {"batch_size": 0}}, good | {"nonsense": 1}, good | {"snapshot": {"lock_strategy": "x"}}):
        with pytest.raises(ConfigError):
            load(json.dumps(bad), {})
