"""Operator 3: secret scan, with a random forest against false positives.

One pattern finds candidates, in one pass over a text. Features of each - its
length, the transitions between its characters, how much of it dictionary words
cover, the path it is from, the words beside it - go through a random forest that
is trained from labelled findings. The trees become one SQL expression, so that a
text's candidates are found, judged and removed inside its row: no Python, no
join, no shuffle, and no text leaves its task.

Labelled findings come from ``labelled_findings`` (made by rules from hashes, the
dictionary and syllables, as no table holds any; a bounded number) or from a table
of the same columns. Both the dictionary (``words_of`` a public vocabulary, or any
list) and the findings are parameters. An empty table of findings, or one with a
single label, can't train a forest: that is an error.

A candidate is matched, judged and masked whole, whatever its length and its marks:
what a name with a cue assigns runs to its closing quote, or to white space. Null and
empty texts have no findings; a text without candidates stays as it is. Repeated
rows are scanned alike. An empty table gives no rows. Extra columns stay, whatever
their names. A candidate with exactly the threshold's score is a secret.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Private keys from BEGIN to END (or to their last long line), values by what stands before them, and long runs with a digit.
#: No upper bounds on a candidate: possessive quantifiers and a run's one start keep it linear. What is looked at before one is bounded.
_BEGIN, _END = (rf"-----{k} [A-Z ]{{0,30}}PRIVATE KEY(?: BLOCK)?-----" for k in ("BEGIN", "END"))
_CUES = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer|passphrase"
#: The name of a value with a cue in it, and what assigns it.
_KEY = rf"(?i:{_CUES})[\w.-]{{0,24}}['\")\]]{{0,2}}[ \t]{{0,2}}[=:]{{1,2}}>?[ \t]{{0,2}}"
CANDIDATE = (
    rf"{_BEGIN}(?:(?:\s|\\[nr])*+[A-Z][A-Za-z-]{{1,30}}+: [^\r\n\\]*+)*+(?:[A-Za-z0-9+/=\s\\\"',;:#*>|]|-(?!----(?:BEGIN|END) ))*+{_END}"
    rf"|{_BEGIN}(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{{40,}}+={{0,2}})*+"
    # what is assigned: in quotes to the closing one, else to white space or to a quote that closes something around it
    r"|(?<=[=:>'\" \t])(?<=[=:][> \t'\"]{0,4})(?:"
    rf"(?<={_KEY}\")(?:[^\"\\\r\n]|\\[^\r\n])++(?=\")|(?<={_KEY}')(?:[^'\\\r\n]|\\[^\r\n])++(?=')"
    rf"|(?<={_KEY}['\"]?)(?!(?i:bearer|basic|digest) )[^\s'\"](?:[^\s'\"]|['\"](?![,;:}}\])>\s]|$))*+"
    # a password of an address
    r"|(?<=:)(?<=[A-Za-z0-9+]://[^\s/:@'\"]{0,64}:)[^\s/@'\"]++(?=@)"
    r"|(?<=[=:]['\" ]{0,2})[A-Za-z0-9!@#$%^&*+/_~-]{8,}+={0,2})"
    r"|(?<= )(?<=(?i:bearer|basic|digest) )(?<=(?i:authorization)['\"]{0,1}[ ]{0,2}[=:][ ]{0,2}['\"]{0,1}[A-Za-z]{5,6} )[^\s'\"]++"
    # tokens in parts, and runs: neither begins inside a word
    r"|(?<![A-Za-z0-9])(?:(?:eyJ[A-Za-z0-9_-]{4,}+|SG)(?:[.][A-Za-z0-9_-]{4,}+){1,4}"
    r"|(?:(?<![+/_-])|(?<=KEY-----))(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2})"
)
#: Fixed words that, before a candidate, speak for or against a secret.
CUES = _CUES
AGAINST = "commit|sha1|sha256|md5|checksum|digest|hash|uuid|guid|example|sample|dummy|placeholder|version|revision|isbn|doi|phone|card|order|invoice|etag|build"
PATHS = "test|example|sample|fixture|mock|spec|docs?/"
#: The dictionary where none is given: fixed words of program texts.
WORDS = tuple("administrator battery because before believe between change children config correct country dragon example family favourite file football garden house index letter little manager master message minute moment monkey mountain name never number office other password people picture please question river school second secret should something staple summer sunshine table there think through thunder together token value voice water welcome where window winter world would yellow user data path default sample test demo your here".split())
#: Letters of the words that count.
SHORTEST, LONGEST = 4, 12
PLACEHOLDER = "xxxx|0000|1234|abcd|aaaa|changeme|placeholder|redacted|example|your[_-]|<|\\\\*\\\\*"
#: Values that name another one, or none.
REFERENCE = "^[$<{%(\\\\[]|^[A-Za-z_.]+[(\\\\[]|^[a-z_]+([.][a-z_]+)+;?$|^(?i:none|null|nil|true|false|str|string|text|bytes|int|undefined|required|optional|unset|empty)[,;)]*$|^[*x.]+$"
FEATURES = {
    "length": "cast(length(c) as double)",
    "digits": "regexp_count(c, '[0-9]') / length(c)",
    "upper": "regexp_count(c, '[A-Z]') / length(c)",
    "lower": "regexp_count(c, '[a-z]') / length(c)",
    "marks": "regexp_count(c, '[^A-Za-z0-9]') / length(c)",
    "turns": "regexp_count(c, '(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]') / length(c)",
    "letter_digit": "regexp_count(c, '[A-Za-z][0-9]|[0-9][A-Za-z]') / length(c)",
    "vowel_pairs": "regexp_count(lower(c), '[aeiou][bcdfghjklmnpqrstvwxyz]|[bcdfghjklmnpqrstvwxyz][aeiou]') / length(c)",
    "repeats": "regexp_count(c, '(.)(?=\\\\1)') / length(c)",
    "different": "size(array_distinct(split(c, ''))) / cast(least(length(c), 64) as double)",
    "hex": "if(c rlike '^[0-9a-fA-F]+$', 1D, 0D)",
    "uuid": "if(c rlike '^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$', 1D, 0D)",
    "known_form": "if(c rlike '^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{30,}|^xox[abprs]-|^eyJ[A-Za-z0-9_-]{10,}|^sk_live_|^sk-[A-Za-z0-9_-]{20,}|^AIza[A-Za-z0-9_-]{30,}|^SG[.]|^glpat-|^npm_[A-Za-z0-9]{30,}|^-----BEGIN', 1D, 0D)",
    "dictionary": "{dictionary} / cast(length(c) as double)",
    "placeholder": f"if(lower(c) rlike '{PLACEHOLDER}', 1D, 0D)",
    "path": f"if(lower(p) rlike '{PATHS}', 1D, 0D)",
    "cue": f"if(b rlike '(?i)({CUES})[^A-Za-z0-9]{{0,6}}$', 1D, 0D)",
    "near_cue": f"if(b rlike '(?i){CUES}', 1D, 0D)",
    "against": f"if(b rlike '(?i){AGAINST}', 1D, 0D)",
    "equals": "if(b rlike '=[\\'\"]?$', 1D, 0D)",
    "address": "if(b rlike '://[^ /:@]{0,64}:$' and a rlike '^@', 1D, 0D)",
    "plain_word": "if(c rlike '^[A-Za-z]+[.,;:!?)]*$', 1D, 0D)",
    "reference": f"if(c rlike '{REFERENCE}', 1D, 0D)",
    "assigned": "if(b rlike '[=:][\\'\" ]{0,2}$', 1D, 0D)",
    "quoted": "if(b rlike '[\\'\"]$' and a rlike '^[\\'\"]', 1D, 0D)",
    "link": "if(b rlike '(://|www[.]|href|src=)[^ ]*$', 1D, 0D)",
    "words_after": "regexp_count(a, '[A-Za-z]{2,}') * 1D",
}
TREES, DEPTH = 24, 6
#: Labelled findings made for training.
FINDINGS = 6000
THRESHOLD = 0.5
BESIDE = 40
MASK = "<SECRET>"


def words_of(vocabulary: str, most: int = 2000) -> tuple[str, ...]:
    """The first whole words of SHORTEST to LONGEST letters of a tokenizer file whose words end in </w>; common words come first."""
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(vocabulary).get_vocab()
    whole = (t.removesuffix("</w>") for t in sorted(ids, key=ids.__getitem__) if t.endswith("</w>"))
    return tuple(w for w in whole if w.isascii() and w.isalpha() and w.islower() and SHORTEST <= len(w) <= LONGEST)[:most]


def covered(words: tuple[str, ...]) -> str:
    """SQL for the number of letters of c that words cover, the longest first, from left to right."""
    by_size = {k: ", ".join(f"'{w}'" for w in words if len(w) == k) for k in range(LONGEST, SHORTEST - 1, -1)}
    longest = "coalesce(" + ", ".join(f"if(substr(w, i, {k}) in ({some}), {k}, null)" for k, some in by_size.items() if some) + ", 0)"
    step = f"if(i < s.next, s, transform(array({longest}), n -> named_struct('next', if(n > 0, i + n, s.next), 'n', s.n + n))[0])"
    # runs in parts of bounded length: what is inside a part costs no more than its length
    return f"aggregate(regexp_extract_all(lower(c), '[a-z]{{{SHORTEST},48}}', 0), 0, (t, w) -> t + aggregate(sequence(1, length(w) - {SHORTEST - 1}), named_struct('next', 1, 'n', 0), (s, i) -> {step}, s -> s.n))"


def features(words: tuple[str, ...]) -> dict[str, str]:
    return {k: sql.replace("{dictionary}", covered(words)) for k, sql in FEATURES.items()}


def labelled_findings(spark: SparkSession, n: int = FINDINGS, words: tuple[str, ...] = WORDS) -> DataFrame:
    """(c, b, a, p, label): n findings of known kind, made by hashes: the same on every run."""
    df = spark.range(n).select("id", *(F.expr(f"sha2(concat('{k}', id), 256)").alias(f"h{k}") for k in "abcde"))
    number = lambda h, at=1: f"cast(conv(substr({h}, {at}, 6), 16, 10) as int)"
    pick = lambda some, h: "element_at(array({}), 1 + {} % {})".format(", ".join(f"'{w}'" for w in some), number(h), len(some))
    df = df.withColumn("words", F.array(*map(F.lit, words[:: max(1, len(words) // 400)])))
    df = df.withColumns({f"w{h}": F.expr(f"element_at(words, 1 + {number(f'h{h}')} % size(words))") for h in "abcde"})
    # what can be spoken but is in no dictionary: syllables by hash
    letters = {"ha": "bcdfghlmnprstvwk", "hb": "aeiouaeioaeiouea", "hc": "nrstlmnrstlmnrst"}
    syllable = ", ".join(f"translate(substr({h}, k, 1), '0123456789abcdef', '{to}')" for h, to in letters.items())
    df = df.withColumn("spoken", F.expr(f"array_join(transform(sequence(1, 3 + {number('he', 20)} % 4), k -> concat({syllable})), '')"))
    name = f"case {number('hc', 9)} % 4 when 0 then concat(initcap(wc), initcap(wd), initcap(we)) when 1 then concat(wc, '_', wd, '_', we) when 2 then concat(wc, '-', wd, '-', spoken) else concat(spoken, '_', wd) end"
    df = df.withColumns({
        "name": F.expr(name), "phrase": F.expr(f"concat(wc, wd, we, if({number('ha', 9)} % 2 = 0, '', wb))"),
        "cue": F.expr(pick(["password=", "token = \"", "secret: ", "api_key=", "\"access_key\": \"", "auth_token = ", "pwd=", "Bearer ", "PASSWORD: ", "credential = "], "hd")),
        "own_cue": F.expr(pick(["password=", "password = ", "password = \"", "\"password\": \"", "passwd: ", "passphrase = \"", "pwd=", "pwd=\"", "PASSWORD: "], "hd")),
        "no": F.expr(pick(["commit ", "sha256: ", "md5 = ", "checksum: ", "version ", "id=", "order ", "etag: \"", "see ", "revision ", "build: ", "card "], "hd")),
        "prose": F.expr(f"concat({pick(['', 'the ', '(', 'and ', '- '], 'he')}, wa, ' ', if({number('hb', 9)} % 2 = 0, spoken, wb), {pick([' ', '. ', ', ', '; '], 'hc')})"),
        "kind": F.expr(f"case {number('he', 3)} % 45 when 42 then 20 when 43 then 22 when 44 then 10 else {number('he', 3)} % 45 end"),
        "address": F.expr(f"concat({pick(['postgres', 'mysql', 'redis', 'https', 'amqp', 'mongodb+srv', 'ftp'], 'hc')}, '://', {pick(['admin', 'root', 'app', 'user1', ''], 'hd')}, ':')"),
        "mark": F.expr("substr('!@#$%^&*?.,;+-_=~|/()[]{}<>', 1 + cast(conv(substr(hd, 2, 4), 16, 10) as int) % 27, 1)"),
        "reference": F.expr(pick(["None", "null", "true", "String", "str,", "required", "getpass()", "${PASSWORD}", "{{ token }}", "$TOKEN", "os.environ[", "<password>", "********", "request.token", "false;", "undefined", "config.secret", "input(", "%s", "self.token", "String;", "process.env.SECRET", "null)", "None)", "true)"], "hd")),
        "colon_cue": F.expr(pick(["password: ", "token: ", "secret: ", "Token: ", "the password: ", "auth: ", "credential: ", "Secrets: "], "ha")),
    })
    hexed = lambda k: f"substr(concat(ha, hb), 1, {k})"
    b64 = "replace(replace(base64(unhex(ha)), '=', ''), '/', '_')"
    upper = "translate(upper(substr(hb, 1, 16)), '01345', 'KQXZW')"
    long = "left(repeat(replace(base64(unhex(concat(ha, hb, hc, hd, he, sha2(ha, 256)))), '\\n', ''), 42), 200 + cast(conv(substr(hd, 9, 4), 16, 10) as int) % 10000)"
    own = "(kind < 10 or kind in (20, 21, 24, 28, 29) or kind between 30 and 37)"
    value = F.expr(
        f"""case kind when 0 then {hexed(40)} when 1 then {hexed(32)} when 2 then {hexed(18)} when 3 then {hexed(64)} when 4 then concat('AKIA', {upper})
        when 5 then concat('AKIA', {upper}) when 6 then {b64} when 7 then concat('ghp_', substr({b64}, 1, 36)) when 8 then concat('eyJ', {b64}) when 9 then concat(substr({b64}, 1, 12), '!', substr(hb, 1, 3))
        when 10 then {hexed(40)} when 11 then {hexed(32)} when 12 then {hexed(64)} when 13 then concat(name, {number('he', 9)} % 100) when 14 then translate(substr(ha, 1, 16), 'abcdef', '012345')
        when 15 then concat_ws('-', substr(ha, 1, 8), substr(ha, 9, 4), substr(ha, 13, 4), substr(ha, 17, 4), substr(ha, 21, 12)) when 16 then concat('your_', wc, '_1234')
        when 17 then concat('xxxxxxxxxxxx', substr(ha, 1, 1)) when 18 then concat(wc, '/', spoken, '/2024-01-', 10 + id % 19) when 19 then name when 20 then {long} when 21 then concat('-----BEGIN ', {pick(['RSA ', 'EC ', '', 'OPENSSH '], 'hb')}, 'PRIVATE KEY-----\\n', regexp_replace(left({long}, 200 + id % 3000), '(.{{64}})', '$1\\n'), '\\n-----END PRIVATE KEY-----')
        when 22 then {long} when 23 then {long} when 24 then phrase when 28 then phrase when 29 then phrase when 25 then spoken when 26 then spoken
        when 30 then concat(left(if(id % 2 = 0, spoken, wa), 6), {number('hb', 3)} % 1000) when 31 then concat(initcap(left(wa, 5)), mark, {number('hb', 3)} % 100, left(wb, id % 4)) when 32 then concat(wa, ' ', mark, wb, ' ', {number('hb', 3)} % 10)
        when 33 then concat(left(wa, id % 7), left({b64}, 4 + id % 12)) when 34 then concat('eyJ', left({b64}, 16), '.eyJ', {b64}, '.', substr({b64}, 3, 30)) when 35 then concat(element_at(array('AIza', 'sk-', 'glpat-', 'SG.'), 1 + cast(id % 4 as int)), substr(replace(base64(unhex(concat(ha, hb))), '/', '-'), 1, 35))
        when 36 then concat(left({b64}, 7), mark, left(wa, 3), '.', mark, substr(hb, 1, 9)) when 37 then wd when 38 then concat(wd, if(id % 3 = 0, '.', '')) when 39 then reference when 40 then {pick(['the', 'a', 'it', 'this', 'see', 'and', 'not', 'is', 'please', 'we'], 'hc')} when 41 then reference
        else concat(wc, '-', wd, if(id % 2 = 0, '', string(id % 10))) end"""
    )
    after = f"case when kind = 33 then concat('@', wd, '.net/', we) when kind in (38, 40) then concat(' ', wd, ' ', spoken) when kind = 32 then if(own_cue like '%\"', '\" ', '\"') else concat({pick(['', ' ', chr(34) + ' ', '. ', chr(34), ', ', chr(10)], 'hc')}, if({number('hd', 9)} % 3 = 0, '', concat(wd, ' ', spoken))) end"
    before = F.expr(f"case when kind in (4, 5, 7, 8, 21, 34, 35) then concat(prose, if(id % 3 = 0, cue, '')) when kind = 33 then concat(prose, address) when kind = 32 then concat(prose, if(own_cue like '%\"', own_cue, concat(rtrim(own_cue), '\"'))) when kind = 37 then concat(prose, if(own_cue like '%: ', 'password=', own_cue)) when kind in (38, 40) then concat(prose, colon_cue) when kind in (39, 41) then concat(prose, if(own_cue like '%\"', 'token = ', own_cue)) when kind < 10 or kind in (16, 17, 20) then concat(prose, cue) when kind in (24, 28, 29, 30, 31, 36) then concat(prose, own_cue) when kind = 14 then concat(prose, if(id % 2 = 0, no, '')) when kind in (13, 18, 19, 26) then concat(prose, if(id % 4 = 0, 'http://www.', '')) when kind = 25 then concat(prose, if(id % 3 = 0, cue, ': ')) when kind = 22 then concat(prose, {pick(['<img src=' + chr(34) + 'data:image/png;base64,', 'url(data:font/woff2;base64,', chr(34) + 'image' + chr(34) + ': ' + chr(34), chr(34) + 'data' + chr(34) + ': ' + chr(34), ''], 'hd')}) else concat(prose, no) end")
    path = F.expr(f"if(not {own} and id % 5 = 0, {pick(['src/test/x', 'docs/a.md', 'examples/b'], 'ha')}, {pick(['src3', 'app/main', 'web', 'config/prod'], 'hb')})")
    return df.select(value.alias("c"), before.alias("b"), F.expr(after).alias("a"), path.alias("p"), F.expr(f"cast({own} as double)").alias("label"))


def train(findings: DataFrame, *, words: tuple[str, ...] = WORDS, trees: int = TREES, depth: int = DEPTH) -> str:
    """SQL for the share of the forest's votes, over the fields of a features struct f."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    names = list(FEATURES)
    table = findings.select("label", *(F.expr(sql).cast("double").alias(k) for k, sql in features(words).items()))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(table).select("label", "features").persist()  # some thousand rows, read again and again
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="onethird").fit(vectors)
    vectors.unpersist()

    def sql(node) -> str:
        if node.numDescendants() == 0:
            stats = list(node.impurityStats().stats())
            return f"{stats[1] / max(sum(stats), 1e-9):.6f}D"
        split = node.split()
        return f"if(f.{names[split.featureIndex()]} <= {split.threshold()!r}D, {sql(node.leftChild())}, {sql(node.rightChild())})"

    votes = " + ".join(f"({sql(tree._java_obj.rootNode())})" if hasattr(tree, "_java_obj") else f"({sql(tree._call_java('rootNode'))})" for tree in model.trees)
    return f"({votes}) / {trees}"


def judged(docs: DataFrame, forest: str, *, words: tuple[str, ...] = WORDS, text: str = "text", path: str | None = "source") -> DataFrame:
    """doc (the row), parts (texts between candidates and candidates in turn: one part without any) and scores (of the candidates)."""
    quoted = CANDIDATE.replace("\\", "\\\\").replace("'", "\\'")
    p = f"coalesce(cast(doc.`{path}` as string), '')" if path else "''"
    fields = ", ".join(f"'{k}', cast({sql} as double)" for k, sql in features(words).items())
    # \u0001\u0003 is put around candidates; a \u0001 of the text is kept apart from it, and neither can be in a candidate
    marked = f"regexp_replace(replace(coalesce(doc.`{text}`, ''), '\\u0001', '\\u0001\\u0002'), '{quoted}', '\\u0001\\u0003$0\\u0001\\u0003')"
    return (
        docs.select(F.struct(*docs.columns).alias("doc"))
        .withColumn("marked", F.expr(marked))
        .withColumn("parts", F.expr("if(contains(marked, '\\u0001\\u0003'), transform(split(marked, '\\u0001\\u0003', -1), x -> replace(x, '\\u0001\\u0002', '\\u0001')), array())"))
        .withColumn("beside", F.expr(f"if(size(parts) > 1, transform(sequence(1, size(parts) - 2, 2), k -> named_struct('c', parts[k], 'b', right(parts[k - 1], {BESIDE}), 'a', left(parts[k + 1], {BESIDE}), 'p', {p})), array())"))
        .withColumn("features", F.expr(f"transform(beside, x -> {_over('x', fields)})"))
        # as long as this number is used, Spark does not move a filter on the scores, and all that they are made of, below
        .select("doc", "parts", F.expr(f"transform(features, f -> {forest})").alias("scores"), F.spark_partition_id().alias("here"))
    )


def _over(struct: str, fields: str) -> str:
    """named_struct(fields) where c, b, a and p are fields of the struct."""
    import re

    return "named_struct(" + re.sub(r"(?<![\w'.\\])([cbap])(?= rlike|[,)])", rf"{struct}.\1", fields) + ")"


#: Lengths are summed up in runs of so many, so that the places of many findings in one text stay cheap.
_RUN = 256
_SUM = "aggregate({}, 0L, (s, x) -> s + x)"


def findings(docs: DataFrame, forest: str, *, words: tuple[str, ...] = WORDS, doc_id: str = "doc_id", text: str = "text", path: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """One row per secret: doc_id, start (in characters), length, value, score."""
    found = F.expr(f"filter(transform(scores, (s, i) -> named_struct('at', 2 * i + 1, 'score', s)), f -> f.score >= {threshold}D)")
    out = judged(docs, forest, words=words, text=text, path=path).withColumn("found", found).filter((F.size("found") > 0) & (F.col("here") >= 0))
    out = out.withColumn("sizes", F.expr("transform(parts, x -> cast(length(x) as bigint))"))
    out = out.withColumn("runs", F.expr(f"transform(sequence(0, (size(sizes) - 1) div {_RUN}), j -> {_SUM.format(f'slice(sizes, cast(j * {_RUN} as int) + 1, {_RUN})')})"))
    out = out.withColumn("before", F.expr(f"transform(sequence(0, size(runs) - 1), j -> {_SUM.format('slice(runs, 1, j)')})"))
    start = f"before[cast(f.at div {_RUN} as int)] + {_SUM.format(f'slice(sizes, cast(f.at div {_RUN} as int) * {_RUN} + 1, f.at % {_RUN})')}"
    return out.select(F.col(f"doc.{doc_id}").alias("doc_id"), F.explode(F.expr(f"transform(found, f -> named_struct('start', {start}, 'value', parts[f.at], 'score', f.score))")).alias("x")).select(
        "doc_id", "x.start", F.length("x.value").alias("length"), "x.value", F.round("x.score", 6).alias("score")
    )


def redact(docs: DataFrame, forest: str, *, words: tuple[str, ...] = WORDS, text: str = "text", path: str | None = "source", threshold: float = THRESHOLD, mask: str = MASK, length: str | None = None) -> DataFrame:
    """docs with every secret replaced by the mask; all other text and columns stay.

    ``length`` names a column, if there is one, with the number of characters of the text.
    """
    out = judged(docs, forest, words=words, text=text, path=path)
    secret = F.expr(f"exists(scores, s -> s >= {threshold}D)")
    clean = F.expr(f"array_join(transform(parts, (x, i) -> if(i % 2 = 1 and scores[cast(i div 2 as int)] >= {threshold}D, '{mask}', x)), '')")
    out = out.withColumn("clean", F.when(secret, clean))
    changed = {text: F.coalesce("clean", F.col(f"doc.`{text}`"))}
    if length in docs.columns:
        changed[length] = F.coalesce(F.length("clean").cast(docs.schema[length].dataType), F.col(f"doc.`{length}`"))
    return out.select(*(changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def report(spark: SparkSession, docs: DataFrame, words: tuple[str, ...] = WORDS) -> DataFrame:
    return findings(docs, train(labelled_findings(spark, words=words), words=words), words=words)
