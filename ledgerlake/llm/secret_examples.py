"""Fixed labelled findings for the secret scan's forest.

``COPIES`` texts of every template, filled from a seeded generator.  What is a
secret is given by the template, not by the forest's measures: quoted,
unquoted, URL, Bearer and prefixed keys and passwords, tags, flags, calls, key
blocks and passphrases against hashes, ids, numbers, public keys, placeholders,
paths, identifiers and prose.  A finding has the path it was met in: passwords
in tests and examples are made up, a bare key in a credentials file is real.
"""

from __future__ import annotations

import random

COPIES, SEED = 40, 3
_CODE_PATHS = ("", "", "", "src/main/app.py", "lib/client.js", "web/index.html", "notes/2021-04.txt", "cmd/run.sh", "src7")
_SECRET_PATHS = (".env", "config/main.yaml", "deploy/prod/values.yml", "home/.netrc", "credentials.json", "conf/application.properties", "secrets/db.txt")
_TEST_PATHS = ("tests/test_login.py", "docs/start.md", "spec/fixtures/user.json", "examples/first/main.go", "samples/app/config.yaml", "pkg/mock/server.go")
_HEX, _LOWER, _DIGITS = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_MIXED = _LOWER + _LOWER.upper() + _DIGITS
_NAMES = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "access_key", "access_token", "client_secret", "auth_token",
          "db_password", "private_key", "credential", "aws_secret_access_key", "service-token")
_PROSE = ("the report of the second quarter shows", "und der lange weg nach hause ist", "see the notes below for", "les derniers mots de la",
          "para la casa de los", "we met at noon and went", "line of the table", "run this with", "old and new", "")
_SYLLABLES = ("ver", "ein", "heit", "ung", "lich", "tion", "men", "ous", "er", "and", "th", "en", "sch", "keit", "ble", "ed", "re", "on", "ar", "que", "los", "ie")
_WORDS = ("river stone bridge window mountain yellow kitchen forest summer market orange pencil copper silent garden planet winter ladder",
          "harbour thunder velvet castle meadow engine blanket feather lantern marble pepper rocket saddle timber violin walnut morning island")
_PREFIXES = (("AKIA", _LOWER.upper() + _DIGITS, 16), ("ASIA", _LOWER.upper() + _DIGITS, 16), ("ghp_", _MIXED, 36), ("gho_", _MIXED, 36), ("glpat-", _MIXED, 20), ("sk-", _MIXED, 48),
             ("sk_live_", _MIXED, 24), ("pk_live_", _MIXED, 24), ("xoxb-", _DIGITS + _LOWER, 40), ("AIza", _MIXED, 35), ("npm_", _MIXED, 36), ("hf_", _MIXED, 34))
_PLACEHOLDERS = ("required", "none", "null", "true", "false", "changeme", "undefined", "optional", "expired", "invalid", "string", "value",
                 "os.environ", "getenv", "config.password", "self.token", "request.headers", "your-token-here", "user_password", "is", "the", "missing")
_AUTHORS = ("author: ", "authors = ", "tokens: ", "max_tokens=", "keys: ", "token_count: ", "authority: ", "password_hint: ")


def examples() -> list[tuple[str, str, bytes, bytes]]:
    """(form, path, text, secret); empty secret: every candidate of the text is harmless."""
    rng, out = random.Random(SEED), []

    def some(letters: str, low: int, high: int | None = None) -> str:
        return "".join(rng.choices(letters, k=rng.randint(low, high or low)))

    def word(low: int = 3, high: int = 8) -> str:
        made = "".join(rng.choices(_SYLLABLES, k=rng.randint(low, high)))
        return rng.choice((made, made, made.capitalize(), made.upper()))

    def key() -> str:
        kind = rng.randrange(6)
        if kind == 0:
            return some(_HEX, 32, 64)
        if kind == 1:
            return some(_HEX.upper(), 32, 64)
        if kind == 2:
            return some(_MIXED + "+/", 22, 86) + rng.choice(("", "=", "=="))
        if kind == 3:
            return some(_MIXED + "+/_-", 200, 2000)
        return some(_MIXED + rng.choice(("", "-_")), 16, 64)

    def password() -> str:
        made = [*some(_MIXED, 5, 12), rng.choice(_DIGITS), rng.choice(_LOWER.upper()), *some("!#$%*@^", 0, 2)]
        rng.shuffle(made)
        return "".join(made)

    def web() -> str:
        return f"eyJ{some(_MIXED, 17, 40)}.{some(_MIXED + '-_', 40, 900)}.{some(_MIXED + '-_', 43)}"

    def name() -> str:
        made = rng.choice(_NAMES)
        return rng.choice((made, made, made.upper(), made.replace("_", "-")))

    def prefixed() -> str:
        start, letters, size = rng.choice(_PREFIXES)
        return start + some(letters, size)

    def uuid() -> str:
        return "-".join(some(_HEX, n) for n in (8, 4, 4, 4, 12))

    def secret() -> str:
        return rng.choice((key, key, password, web, prefixed))()

    def number() -> str:
        return some(_DIGITS, 16, rng.choice((16, 16, 24)))

    def base64(low: int, high: int | None = None) -> str:
        return some(_MIXED + "+/", low, high)

    def host() -> str:
        return f"{some(_LOWER, 4, 9)}.{rng.choice(('org', 'net', 'local'))}"

    def phrase() -> str:
        known = " ".join(_WORDS).split()
        if rng.random() < 0.5:
            return " ".join(rng.choices(known, k=rng.randint(4, 6)))
        known += " ".join(_PROSE).split()
        return " ".join(rng.choice((rng.choice(known), rng.choice(known), word(1, 3).lower())) for _ in range(rng.randint(4, 12)))

    def block(kind: str) -> str:
        return f"-----BEGIN {kind}-----\n" + "\n".join(base64(64) for _ in range(rng.randint(3, 25))) + "\n"

    real = {
        "double quotes": (lambda: f'{name()} = "', secret, '"'), "single quotes": (lambda: f"{name()} = '", secret, "'"), "json": (lambda: f'"{name()}": "', secret, '",'),
        "name=value": (lambda: f"{name()}=", secret, ""), "NAME=value": (lambda: f"{name().upper()}=", key, "\n"), "yaml": (lambda: f"{name()}: ", secret, ""),
        "name=password": (lambda: f"{name()}=", password, "\n"),
        "url query": (lambda: f"https://{some(_LOWER, 6)}.org/{some(_LOWER, 5)}?{rng.choice(('token', 'api_key', 'access_token'))}=", key, rng.choice(("", "&page=2"))),
        "header": (lambda: "Authorization: Bearer ", secret, ""), "curl": (lambda: "curl -H 'Bearer ", key, "'"), "bearer": (lambda: "bearer ", key, " "),
        "prefixed": (lambda: "", prefixed, " "), "web token": (lambda: "", web, " "), "prefixed id": (lambda: "id: ", prefixed, ""), "prefixed in quotes": (lambda: '"', prefixed, '"'),
        "url user": (lambda: f"{rng.choice(('https', 'postgres', 'amqp', 'redis', 'mongodb'))}://{rng.choice(('', some(_LOWER, 4, 8)))}:", lambda: rng.choice((password, key))()[:40].replace("/", "x"), f"@{host()}:5432/main"),
        "tag": (lambda: f"<{(tag := rng.choice(('password', 'secretKey', 'apiKey', 'token', 'authToken')))}>", secret, "</x>"),
        "connection string": (lambda: f"AccountName={some(_LOWER, 5, 9)};AccountKey=", lambda: base64(86) + "==", ";EndpointSuffix=core"),
        "dotted": (lambda: rng.choice(("", "key ", "KEY=")), lambda: f"SG.{some(_MIXED + '-_', 22)}.{some(_MIXED + '-_', 43)}", " "),
        "flag": (lambda: f"run {rng.choice(('--password', '--token', '--api-key', '--client-secret', '-password'))} ", secret, " --verbose"),
        "-p": (lambda: f"{rng.choice(('mysql -u root', 'sshpass', 'redis-cli', 'docker login -u me'))} -p ", password, f" {host()}"),
        "call": (lambda: f'{rng.choice(("set_token", "login", "Client", "connect", "with_api_key"))}({rng.choice(("", "user, ", repr(some(_LOWER, 5)) + ", "))}"', key, '")'),
        "passphrase": (lambda: f'{rng.choice(("passphrase", "PASSPHRASE", "key_passphrase", "mnemonic", "wallet_mnemonic"))}{rng.choice((" = ", ": ", "="))}"', phrase, '"'),
        "private key": (lambda: "", lambda: block(rng.choice(("RSA PRIVATE KEY", "PRIVATE KEY", "EC PRIVATE KEY", "OPENSSH PRIVATE KEY"))), "-----END KEY-----"),
    }
    in_secret_file = {"bare key of a credentials file": (lambda: "", key, "")}
    in_tests = {
        "test password": lambda: f"{name()}{rng.choice(('=', ': '))}{password()}", "quoted test password": lambda: f'{name()} = "{password()}"',
        "test url user": lambda: f"https://{some(_LOWER, 5)}:{password()}@{host()}/", "test tag": lambda: f"<password>{password()}</password>",
    }
    harmless = {
        "commit": lambda: f"commit {some(_HEX, 40)}", "sha256": lambda: f"sha256: {some(_HEX, 64)}", "checksum": lambda: f"checksum = {some(_HEX, 32)}", "etag": lambda: f'etag: "{some(_HEX, 32)}"',
        "hex": lambda: some(_HEX, 40), "quoted hex": lambda: f'"{some(_HEX, 40)}"', "id=uuid": lambda: f"id={uuid()}", "quoted uuid": lambda: f'uuid = "{uuid()}"', "uuid": uuid,
        "number": number, "another number": number, "number token": lambda: f"{number()} token", "number and key": lambda: f"{number()} the key and the secret",
        "order": lambda: f"order={number()}", "isbn": lambda: f'isbn: "{number()}"',
        "long word": lambda: word(6, 14), "another long word": lambda: word(6, 14), "quoted word": lambda: f'"{word(6, 14)}"', "word is the key": lambda: f"{word(6, 14)} is the key token",
        "title": lambda: f"title = '{word(6, 12)}'",
        "path": lambda: "/".join(some(_LOWER, 3, 9) for _ in range(5)), "path=": lambda: f"path=/usr/{some(_LOWER, 4, 9)}/{some(_LOWER, 4, 9)}/lib",
        "snake": lambda: "_".join(word(1, 3).lower() for _ in range(5)), "camel": lambda: f"get{word(2, 4)}For{word(2, 4)}()", "rule": lambda: "-" * rng.randint(16, 80),
        "crosses": lambda: "x" * rng.randint(16, 900),
        "image": lambda: f"data:image/png;base64,iVBORw0KGgo{base64(60, 1500)}", "url": lambda: f"https://{some(_LOWER, 6)}.org/{some(_LOWER, 12)}/{some(_LOWER, 9)}?page=2",
        "placeholder": lambda: f"{name()}: {rng.choice(_PLACEHOLDERS)}", "quoted placeholder": lambda: f'{name()} = "{rng.choice(_PLACEHOLDERS)}"',
        "name=placeholder": lambda: f"{name()}={rng.choice(_PLACEHOLDERS)}", "name: word": lambda: f"{name()}: {word(2, 5)}",
        "author": lambda: f"{rng.choice(_AUTHORS)}{word(2, 5)}", "count": lambda: f"{rng.choice(_AUTHORS)}{some(_DIGITS, 4, 6)}", "the bearer": lambda: f"the bearer {word(2, 4)}",
        "function": lambda: f"{name()} = {word(2, 4).lower()}({word(2, 4).lower()})",
        "ssh public key": lambda: f"ssh-rsa AAAAB3NzaC1yc2EAAAADAQABAAAB{base64(200, 360)} me@{host()}", "short public key": lambda: f"ssh-ed25519 AAAAC3NzaC1lZDI1NTE5AAAAI{base64(43)} me",
        "certificate": lambda: block(rng.choice(("CERTIFICATE", "PUBLIC KEY", "RSA PUBLIC KEY"))) + "-----END X-----", "integrity": lambda: f'integrity="sha384-{base64(64)}"',
        "variable": lambda: f"{name()}{rng.choice(('=', ': '))}{rng.choice(('${', '{{', '<', '%('))}{name().upper()}{rng.choice(('}', '}}', '>', ')s'))}",
        "url with variable": lambda: f"postgres://{some(_LOWER, 5)}:{rng.choice(('${DB_PASSWORD}', 'password', '$PW', 'changeme', 'your-password'))}@{host()}/main",
        "url with port": lambda: f"https://{host()}:{some(_DIGITS, 4)}/{some(_LOWER, 9)}", "tag with word": lambda: f"<{rng.choice(('password', 'author', 'token'))}>{rng.choice((*_PLACEHOLDERS, word(2, 4)))}</x>",
        "flag with variable": lambda: f"run {rng.choice(('--password', '--token'))} {rng.choice(('$TOKEN', '${PW}', 'required', '<token>', '--verbose', 'file'))}",
        "phrase to enter": lambda: f'passphrase: "{rng.choice(("enter", "please enter", "type"))} your passphrase{rng.choice((" here", "", " again"))}"',
        "call with path": lambda: f'get_token("{"/".join(some(_LOWER, 4, 9) for _ in range(4))}")', "example key": lambda: f"{rng.choice(_PREFIXES)[0]}{some(_MIXED, 8, 20)}EXAMPLE",
    }
    for _ in range(COPIES):
        for templates, paths in ((real, (*_CODE_PATHS, *_SECRET_PATHS)), (in_secret_file, _SECRET_PATHS)):
            for form, (before, value, after) in templates.items():
                made = value()
                out.append((form, rng.choice(paths), f"{rng.choice(_PROSE)} {before()}{made}{after} {rng.choice(_PROSE)}".encode(), made.encode()))
        for templates, paths in ((harmless, (*_CODE_PATHS, *_CODE_PATHS, *_TEST_PATHS)), (in_tests, _TEST_PATHS)):
            for form, make in templates.items():
                out.append((form, rng.choice(paths), f"{rng.choice(_PROSE)} {make()} {rng.choice(_PROSE)}".encode(), b""))
    return out
