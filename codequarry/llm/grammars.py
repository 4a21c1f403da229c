"""Token streams and grammars of one function definition in C, C++ and Java, for parsing with derivatives."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

from codequarry.llm.derivatives import Language

# The reserved words that the grammars tell apart. Other names are identifiers, also types and macros.
C_WORDS = "auto break case char const continue default do double else enum extern float for goto if inline int long register restrict return short signed sizeof static struct switch typedef union unsigned void volatile while _Bool _Complex _Noreturn _Thread_local _Atomic _Alignof __attribute__ __inline __inline__ __restrict __restrict__ __extension__ __volatile__ asm __asm__ typeof __typeof__".split()
CPP_WORDS = "auto break case catch char class const const_cast constexpr continue default delete do double dynamic_cast else enum explicit extern float for friend goto if inline int long mutable namespace new noexcept operator override final private protected public register reinterpret_cast return short signed sizeof static static_cast struct switch template throw try typedef typeid typename union unsigned using virtual void volatile while wchar_t bool char16_t char32_t decltype co_return co_await co_yield static_assert __attribute__ __inline __restrict thread_local asm __asm__ alignof typeof __typeof__".split()
JAVA_WORDS = "abstract assert boolean break byte case catch char class continue default do double else enum extends final finally float for if implements import instanceof int interface long native new package private protected public return short static strictfp super switch synchronized this throw throws transient try void volatile while".split()
# Punctuators, longest first. '>' is always one token, as in nested type arguments.
PUNCT = "... <<= <=> ->* .* :: -> ++ -- << <= >= == != && || += -= *= /= %= &= ^= |= ## { } ( ) [ ] ; : , . < > + - * / % & | ^ ! ~ = ? @ #".split()

_NUMBER = r"\.?[0-9](?:[eEpP][+-]|'[0-9A-Za-z]|[0-9A-Za-z_.])*"
_LEX = re.compile(
    r"//(?:[^\n\\]|\\[\s\S])*|/\*[\s\S]*?\*/|/\*"
    r'|(?:u8|[uUL])?R"([^()\\\s]{0,16})\([\s\S]*?\)\1"'.replace("([^", "(?P<d>[^").replace(r"\1", "(?P=d)")
    + r'|"""[\s\S]*?"""|(?:u8|[uUL])?"(?:\\[\s\S]|[^"\\\n])*"|(?:u8|[uUL])?\'(?:\\[\s\S]|[^\'\\\n])+\''
    + "|" + _NUMBER + r"|[^\W\d][\w$]*|\$[\w$]*|" + "|".join(map(re.escape, PUNCT)) + r"|\\\r?\n|\S"
)
_BLANK = re.compile(r'("(?:\\[\s\S]|[^"\\\n])*"|\'(?:\\[\s\S]|[^\'\\\n])*\')|//(?:[^\n\\]|\\[\s\S])*|/\*[\s\S]*?\*/')
_DIRECTIVE = re.compile(r"\s*#\s*(if|ifdef|ifndef|elif|elifdef|elifndef|else|endif|define|undef|include|include_next|import|pragma|error|warning|line|ident)?\b(.*)", re.S)


class _Conditional:
    """One #if ... #endif: the (macro or expression, value) under which each branch is taken, None for #else."""

    def __init__(self):
        self.conditions: list[tuple[str, bool] | None] = []

    def closed(self) -> bool:
        return self.conditions[-1] is None


def _condition(word: str, rest: str) -> tuple[str, bool]:
    rest = " ".join(rest.split())
    m = re.fullmatch(r"(!?) ?(?:defined ?\(? ?(\w+) ?\)?|(\w+))", rest)
    if word.endswith("def"):
        return "defined " + rest, not word.endswith("ndef")
    if m and m.group(2):
        return "defined " + m.group(2), not m.group(1)
    if m and not m.group(3).isdigit():
        return m.group(3), not m.group(1)
    return rest, True


def without_directives(text: str) -> tuple[list[tuple[str, list[tuple[int, int]]]], list[_Conditional], bool] | None:
    """C text without preprocessor lines: each line with the branches (conditional, branch) that it lies in, outermost
    first, the conditionals, and whether every conditional ends. None if a line that begins with # is no directive or
    an #else, #elif or #endif has no #if."""
    text = _BLANK.sub(lambda m: m.group(1) or re.sub(r"[^\n]+", " ", m.group(0)), text)
    out, found, stack = [], [], []  # stack: (conditional, branch)
    lines = iter(text.split("\n"))
    for line in lines:
        if line.lstrip()[:1] == "#":
            while line.rstrip("\r").endswith("\\"):
                nxt = next(lines, None)
                if nxt is None:
                    break
                line = line.rstrip("\r")[:-1] + " " + nxt
                out.append(("", []))
            m = _DIRECTIVE.match(line)
            word = m.group(1) if m else None
            if word is None and line.strip() != "#":
                return None
            if word in ("if", "ifdef", "ifndef"):
                found.append(_Conditional())
                found[-1].conditions.append(_condition(word, m.group(2)))
                stack = [*stack, (len(found) - 1, 0)]
            elif word in ("elif", "elifdef", "elifndef", "else", "endif"):
                if not stack or word != "endif" and found[stack[-1][0]].closed():
                    return None
                if word == "endif":
                    stack = stack[:-1]
                else:
                    c, k = stack[-1]
                    found[c].conditions.append(None if word == "else" else _condition(word, m.group(2)))
                    stack = [*stack[:-1], (c, k + 1)]
            out.append(("", stack))  # so that a branch without text has a line too
        else:
            out.append((line, stack))
    return out, found, not stack


def _choose(found: list[_Conditional], forced: dict[int, int], wanted: set[tuple[int, int]]) -> list[int]:
    """The branch of each conditional, -1 for none. One condition has one value in all conditionals; what is not settled
    by that goes to the first wanted branch, else to the first."""
    known: dict[str, bool] = {"0": False}

    def take(c: int, k: int) -> None:
        for i, x in enumerate(found[c].conditions[: k + 1]):
            if x:
                known.setdefault(x[0], x[1] == (i == k))

    for c, k in forced.items():
        take(c, k)
    out = []
    for c, cond in enumerate(found):
        if c in forced:
            out.append(forced[c])
            continue
        can = []
        for k, x in enumerate(cond.conditions):
            value = True if x is None else known[x[0]] == x[1] if x[0] in known else None
            if value is not False:
                can.append(k)
            if value:
                break
        k = next((k for k in can if (c, k) in wanted), can[0] if can else -1)
        if k >= 0:
            take(c, k)
        out.append(k)
    return out


def variants(lines: list[tuple[str, list[tuple[int, int]]]], found: list[_Conditional]) -> Iterator[tuple[str, Callable[[bool], None]]]:
    """Texts of some choices of branches, until each branch lies in one that is valid; the caller says of
    each whether it is. After a choice that is not valid, what it was to try is tried branch by branch; a branch for which
    that fails too ends the series. The first choice takes first branches. '#if 0' is never taken."""
    paths = {path[i]: path[: i + 1] for _, path in lines for i in range(len(path))}
    dead = {(c, k) for c, x in enumerate(found) for k, y in enumerate(x.conditions) if y == ("0", True)}
    wanted = {b for b, path in paths.items() if not dead & {*path}}

    def made(forced: dict[int, int], wish: set) -> tuple[str, set]:
        chosen = _choose(found, forced, wish)
        on = [all(chosen[c] == k for c, k in path) for _, path in lines]
        return "\n".join(line if x else "" for (line, _), x in zip(lines, on)), {b for (_, path), x in zip(lines, on) if x for b in path}

    said: list[bool] = []
    text, holds = made({}, set())
    yield text, said.append
    if not said.pop():
        return
    wanted -= holds
    alone = False  # whether a branch is tried with first branches elsewhere
    while wanted:
        target = min(wanted)
        text, holds = made(dict(paths[target]), set() if alone else wanted)
        yield text, said.append
        if said.pop():
            wanted -= holds
            alone = False
        elif alone:
            return
        else:
            alone = True


class Lexer:
    def __init__(self, words: list[str]):
        names = ["IDENT", "NUM", "STR", "CHAR", "BAD", *words, *PUNCT]
        self.kinds = {n: i for i, n in enumerate(dict.fromkeys(names))}
        self.fixed = {n: self.kinds[n] for n in [*words, *PUNCT]} | {"#": self.kinds["BAD"], "##": self.kinds["BAD"], "/*": self.kinds["BAD"]}
        self.seen: dict[str, int] = dict(self.fixed)

    def _kind(self, s: str) -> int:
        c = s[0]
        if s.startswith(("//", "/*")) and len(s) > 1 or s[0] == "\\" and len(s) > 1:
            k = -1
        elif c.isdigit() or (c == "." and len(s) > 1 and s[1].isdigit()):
            k = self.kinds["NUM"]
        elif s[-1] == '"' and len(s) > 1:
            k = self.kinds["STR"]
        elif s[-1] == "'" and len(s) > 1:
            k = self.kinds["CHAR"]
        elif c.isalpha() or c in "_$":
            k = self.kinds["IDENT"]
        else:
            k = self.kinds["BAD"]
        if len(s) < 64:
            if len(self.seen) > 500_000:
                self.seen = dict(self.fixed)
            self.seen[s] = k
        return k

    def tokens(self, text: str) -> list[int]:
        seen, kind = self.seen, self._kind
        out = []
        for m in _LEX.finditer(text) if 'R"' in text else ():
            s = m.group()
            k = seen.get(s)
            out.append(kind(s) if k is None else k)
        if not out:
            for s in _PLAIN.findall(text):
                k = seen.get(s)
                out.append(kind(s) if k is None else k)
        return [k for k in out if k >= 0]


_PLAIN = re.compile(
    r"//(?:[^\n\\]|\\[\s\S])*|/\*[\s\S]*?\*/|/\*"
    r'|"""[\s\S]*?"""|(?:u8|[uUL])?"(?:\\[\s\S]|[^"\\\n])*"|(?:u8|[uUL])?\'(?:\\[\s\S]|[^\'\\\n])+\''
    "|" + _NUMBER + r"|[^\W\d][\w$]*|\$[\w$]*|" + "|".join(map(re.escape, PUNCT)) + r"|\\\r?\n|\S"
)

_ASSIGN = "'=' | '+=' | '-=' | '*=' | '/=' | '%=' | '&=' | '^=' | '|=' | '<<=' | '>' '>='"
_BINARY = "'+' | '-' | '*' | '/' | '%' | '&' | '|' | '^' | '&&' | '||' | '==' | '!=' | '<' | '>' | '<=' | '>=' | '<<' | '>' '>'"

C = {
    "unit": "'__extension__'? specs declarator_f attr* (kr_decl)* block ';'?",
    "attr": "'__attribute__' '(' '(' balanced* ')' ')' | asm '(' balanced* ')'",
    "asm": "'asm' | '__asm__'",
    "balanced": "'(' balanced* ')' | 'IDENT' | 'NUM' | 'STR' | 'CHAR' | ',' | 'const' | '=' | '+' | '-' | '*' | ':' | '[' | ']' | '&' | '|' | '.' | '->' | 'int' | 'long' | 'char' | 'unsigned' | 'struct' | 'volatile'",
    "storage": "'static' | 'extern' | 'inline' | 'register' | 'auto' | 'typedef' | '_Noreturn' | '_Thread_local' | '__inline' | '__inline__' | attr",
    "qual": "'const' | 'volatile' | 'restrict' | '_Atomic' | '__restrict' | '__restrict__' | '__volatile__'",
    "basic": "'void' | 'char' | 'short' | 'int' | 'long' | 'float' | 'double' | 'signed' | 'unsigned' | '_Bool' | '_Complex'",
    "named": "'IDENT' | ('struct' | 'union') attr* ('IDENT' | 'IDENT'? '{' member* '}') | 'enum' ('IDENT' | 'IDENT'? '{' enumerator (',' enumerator)* ','? '}') | ('typeof' | '__typeof__') '(' (expr | type) ')'",
    "enumerator": "'IDENT' ('=' cond)?",
    "member": "specs_t member_d (',' member_d)* ';' | ';' | ('struct' | 'union') '{' member* '}' ';'",
    "member_d": "declarator (':' cond)? attr* | ':' cond",
    "specs": "(storage | qual)* (named (storage | qual)* | basic (basic | storage | qual)*)",
    "specs_t": "qual* (named qual* | basic (basic | qual)*)",
    "pointer": "'*' (qual | attr)*",
    "declarator_f": "pointer* ('IDENT' | '(' 'IDENT' ')') '(' params? ')' | pointer* '(' pointer+ 'IDENT' '(' params? ')' ')' '(' params? ')'",
    "declarator": "(pointer | '^')* ('IDENT' | '(' attr* declarator ')') suffix*",
    "abstract": "pointer+ abstract_d? | abstract_d",
    "abstract_d": "'(' abstract ')' suffix* | suffix+",
    "suffix": "'[' ('static' | qual)* expr? ']' | '(' params? ')' | '[' '*' ']'",
    "params": "param (',' param)* (',' '...')? | '...'",
    "param": "specs (declarator | abstract)? attr*",
    "kr_decl": "specs declarator (',' declarator)* ';'",
    "type": "specs_t abstract?",
    "declaration": "'__extension__'? specs (init_d (',' init_d)*)? ';'",
    "init_d": "declarator attr* ('=' init)?",
    "init": "assign | '{' (init_item (',' init_item)* ','?)? '}'",
    "init_item": "((designator+ '=') | 'IDENT' ':')? init",
    "designator": "'.' 'IDENT' | '[' cond ('...' cond)? ']'",
    "block": "'{' item* '}'",
    "item": "declaration | statement | label | nested_f",
    "nested_f": "specs declarator_f block",
    "label": "'IDENT' ':' attr* | 'case' cond ('...' cond)? ':' | 'default' ':'",
    "statement": "label* (block | expr? ';' | 'if' '(' expr ')' statement ('else' statement)? | 'while' '(' expr ')' statement | 'do' statement 'while' '(' expr ')' ';' | 'for' '(' (declaration | expr? ';') expr? ';' expr? ')' statement | 'switch' '(' expr ')' statement | 'goto' ('IDENT' | '*' expr) ';' | 'break' ';' | 'continue' ';' | 'return' expr? ';' | asm_s | attr ';')",
    "asm_s": "asm ('volatile' | '__volatile__' | 'goto' | 'inline')* '(' balanced* ')' ';'",
    "expr": "assign (',' assign)*",
    "assign": "unary ((" + _ASSIGN + ") (assign | '{' '}') | ((" + _BINARY + ") unary)* ('?' expr? ':' assign)?)",
    "cond": "unary ((" + _BINARY + ") unary)* ('?' expr? ':' cond)?",
    "unary": "('++' | '--' | '&' | '*' | '+' | '-' | '!' | '~' | '__extension__') unary | '&&' 'IDENT' | ('sizeof' | '_Alignof') (unary | '(' type ')') | '(' type ')' (unary | '{' (init_item (',' init_item)* ','?)? '}' post*) | primary post*",
    "primary": "'IDENT' | 'NUM' | 'CHAR' | 'STR' ('STR' | 'IDENT')* | 'IDENT' 'STR' ('STR' | 'IDENT')* | '(' expr ')' | '(' block ')'",
    "post": "'[' expr ']' | '(' (arg (',' arg)*)? ')' | '.' 'IDENT' | '->' 'IDENT' | '++' | '--'",
    "arg": "assign | type",
}

_CPP_OPERATOR = "'new' ('[' ']')? | 'delete' ('[' ']')? | '(' ')' | '[' ']' | '->' | '->*' | ',' | '!' | '~' | '++' | '--' | '<=>' | 'IDENT' | " + _ASSIGN + " | " + _BINARY

CPP = {
    "unit": "template* attr* (specs declarator_f | storage* special_f) tail* ctor_init? (body | 'try' body handler+) ';'?",
    "template": "'template' '<' (tparam (',' tparam)*)? '>'",
    "tparam": "('typename' | 'class') '...'? 'IDENT'? ('=' type)? | specs '...'? declarator? ('=' cond_t)?",
    "attr": "'__attribute__' '(' '(' balanced* ')' ')' | '[' '[' balanced* ']' ']'",
    "balanced": "'(' balanced* ')' | 'IDENT' | 'NUM' | 'STR' | 'CHAR' | ',' | 'const' | '::' | '='",
    "storage": "'static' | 'extern' 'STR'? | 'inline' | 'register' | 'typedef' | 'virtual' | 'explicit' | 'friend' | 'mutable' | 'constexpr' | 'thread_local' | '__inline' | attr",
    "qual": "'const' | 'volatile' | '__restrict'",
    "basic": "'void' | 'char' | 'short' | 'int' | 'long' | 'float' | 'double' | 'signed' | 'unsigned' | 'bool' | 'wchar_t' | 'char16_t' | 'char32_t'",
    "targs": "'<' (targ (',' targ)*)? '>'",
    "targ": "(type | cond_t) '...'?",
    "word": "'IDENT' | 'override' | 'final'",
    "name": "'::'? (word targs? '::' 'template'?)* word targs?",
    "named": "'typename'? name | ('struct' | 'union' | 'class') attr* (name | 'IDENT'? 'final'? bases? '{' member* '}') | 'enum' ('class' | 'struct')? (name | 'IDENT'? (':' specs)? '{' (enumerator (',' enumerator)* ','?)? '}') | 'auto' | 'decltype' '(' expr ')' | ('typeof' | '__typeof__') '(' (expr | type) ')'",
    "bases": "':' base (',' base)*",
    "base": "('public' | 'private' | 'protected' | 'virtual')* name",
    "enumerator": "'IDENT' ('=' cond)?",
    "member": "declaration | ('public' | 'private' | 'protected') ':' | unit | ';' | storage* special_f tail* ';'",
    "specs": "(storage | qual)* (named (storage | qual)* | basic (basic | storage | qual)*)",
    "specs_t": "qual* (named qual* | basic (basic | qual)*)",
    "pointer": "('*' | '&' | '&&' | (word targs? '::')+ '*') (qual | attr)*",
    "id": "'::'? (word targs? '::' 'template'?)* ('~'? word targs? | 'operator' (" + _CPP_OPERATOR + "))",
    "declarator_f": "pointer* id '(' params? ')'",
    "special_f": "id '(' params? ')' | '::'? (word targs? '::')* 'operator' type '(' ')'",
    "tail": "'const' | 'volatile' | 'noexcept' ('(' cond ')')? | 'override' | 'final' | '&' | '&&' | 'throw' '(' (type (',' type)*)? ')' | '->' type | attr | '=' ('NUM' | 'default' | 'delete')",
    "ctor_init": "':' ctor_item (',' ctor_item)*",
    "ctor_item": "name ('(' args? ')' | '{' args? '}') '...'?",
    "body": "block",
    "handler": "'catch' '(' (param | '...') ')' block",
    "declarator": "pointer* '...'? (id | '(' declarator ')') suffix*",
    "abstract": "pointer+ abstract_d? | abstract_d",
    "abstract_d": "'(' abstract ')' suffix* | suffix+",
    "suffix": "'[' expr? ']' | '(' params? ')' tail*",
    "params": "param (',' param)* (','? '...')? | '...'",
    "param": "specs '...'? (declarator | abstract)? ('=' init)? attr*",
    "type": "specs_t abstract?",
    "declaration": "specs (init_d (',' init_d)*)? ';' | 'using' ('namespace' name | word '=' type | 'typename'? name) ';' | ('static_assert' '(' args ')') ';' | (storage | qual)* 'auto' (qual | '&' | '&&')* '[' 'IDENT' (',' 'IDENT')* ']' ('=' init | braced | '(' expr ')') ';'",
    "init_d": "declarator (':' cond)? attr* ('=' init | '(' args ')' | braced)?",
    "init": "assign | braced",
    "braced": "'{' (init_item (',' init_item)* ','?)? '}'",
    "init_item": "((designator+ '=') | 'IDENT' ':')? init '...'?",
    "designator": "'.' 'IDENT' | '[' cond ']'",
    "block": "'{' item* '}'",
    "item": "declaration | statement | label",
    "label": "'IDENT' ':' attr* | 'case' cond ('...' cond)? ':' | 'default' ':' | attr",
    "condition": "expr | specs declarator ('=' init | braced)",
    "head": "(declaration | expr? ';')? condition",
    "statement": "label* (block | expr? ';' | 'if' 'constexpr'? '(' head ')' statement ('else' statement)? | 'while' '(' condition ')' statement | 'do' statement 'while' '(' expr ')' ';' | 'for' '(' (declaration | expr? ';') condition? ';' expr? ')' statement | 'for' '(' (declaration | expr ';')? specs (declarator | pointer* '[' 'IDENT' (',' 'IDENT')* ']') ':' init ')' statement | 'switch' '(' head ')' statement | 'goto' 'IDENT' ';' | 'break' ';' | 'continue' ';' | ('return' | 'co_return') init? ';' | 'try' block handler+ | asm_s)",
    "asm_s": "('asm' | '__asm__') 'volatile'? '(' (balanced | ':' | '=' | '&' | '+')* ')' ';'",
    "expr": "assign (',' assign)*",
    "assign": "unary ((" + _ASSIGN + ") init | ((" + _BINARY + " | '<=>' | '.*' | '->*') unary)* ('?' expr ':' assign | (" + _ASSIGN + ") init)?) | 'throw' assign? | 'co_yield' init",
    "cond": "unary ((" + _BINARY + " | '<=>') unary)* ('?' expr ':' cond)?",
    "cond_t": "unary (('+' | '-' | '*' | '/' | '%' | '&' | '|' | '^' | '&&' | '||' | '==' | '!=' | '<' | '<=' | '<<') unary)*",
    "unary": "('++' | '--' | '&' | '&&' | '*' | '+' | '-' | '!' | '~' | 'co_await') unary | ('sizeof' | 'alignof') ('...'? unary | '(' type ')') | '(' type ')' (unary | braced post*) | '::'? 'new' ('(' args ')')? (new_type ('(' args? ')' | braced)? | '(' type ')' ('(' args? ')' | braced)?) post* | '::'? 'delete' ('[' ']')? unary | primary post*",
    "new_type": "specs_t ('*' qual*)* ('[' expr ']')*",
    "primary": "id | 'NUM' | 'CHAR' | 'STR' ('STR' | 'IDENT')* | '(' expr ')' | '(' block ')' | lambda | ('static_cast' | 'dynamic_cast' | 'const_cast' | 'reinterpret_cast') '<' type '>' '(' expr ')' | 'typeid' '(' (expr | type) ')' | 'noexcept' '(' expr ')' | basic+ ('(' args? ')' | braced) | name braced | 'typename' name ('(' args? ')' | braced) | 'decltype' '(' expr ')' | '(' assign (" + _BINARY + ") '...' ')'",
    "lambda": "'[' (capture (',' capture)*)? ']' targs? ('(' params? ')' ('mutable' | 'constexpr' | 'noexcept' | attr)* ('->' type)?)? block",
    "capture": "'&' | '=' | '&'? 'IDENT' ('=' init)? '...'? | '*' 'IDENT'",
    "post": "'[' init ']' | '(' args? ')' | ('.' | '->') 'template'? id | '++' | '--'",
    "args": "arg (',' arg)*",
    "arg": "(init | type) '...'?",
}

JAVA = {
    "unit": "method",
    "method": "modifier* tparams? (type 'IDENT' '(' params? ')' dims? | 'IDENT' '(' params? ')') ('throws' name (',' name)*)? block",
    "modifier": "'public' | 'private' | 'protected' | 'static' | 'final' | 'abstract' | 'native' | 'synchronized' | 'strictfp' | 'transient' | 'volatile' | 'default' | annotation",
    "annotation": "'@' name ('(' (annotation_v (',' annotation_v)*)? ')')?",
    "annotation_v": "('IDENT' '=')? (cond | annotation | '{' (annotation_v (',' annotation_v)*)? ','? '}')",
    "tparams": "'<' tparam (',' tparam)* '>'",
    "tparam": "annotation* 'IDENT' ('extends' type ('&' type)*)?",
    "dims": "(annotation* '[' ']')+",
    "basic": "'int' | 'long' | 'boolean' | 'byte' | 'short' | 'char' | 'float' | 'double'",
    "targs": "'<' (targ (',' targ)*)? '>'",
    "targ": "annotation* (type | '?' (('extends' | 'super') type)?)",
    "name": "'IDENT' ('.' 'IDENT')*",
    "class_t": "'IDENT' targs? ('.' annotation* 'IDENT' targs?)*",
    "type": "(basic | class_t) dims? | 'void'",
    "local_t": "(basic | class_t) dims?",
    "params": "param (',' param)*",
    "param": "('final' | annotation)* local_t (annotation* '...')? ('IDENT' | 'this') dims?",
    "block": "'{' item* '}'",
    "item": "local ';' | statement | class_d",
    "local": "('final' | annotation)* local_t var (',' var)*",
    "var": "'IDENT' dims? ('=' init)?",
    "init": "assign | '{' (init (',' init)*)? ','? '}'",
    "class_d": "modifier* ('class' 'IDENT' tparams? ('extends' class_t)? ('implements' class_t (',' class_t)*)? class_b | 'interface' 'IDENT' tparams? ('extends' class_t (',' class_t)*)? class_b | 'enum' 'IDENT' '{' ('IDENT' (',' 'IDENT')*)? ','? (';' member*)? '}')",
    "class_b": "'{' member* '}'",
    "member": "';' | method | class_d | modifier* tparams? type 'IDENT' '(' params? ')' ('throws' name (',' name)*)? ';' | modifier* local_t var (',' var)* ';' | 'static'? block",
    "statement": "('IDENT' ':')* (block | ';' | expr_s ';' | 'if' '(' expr ')' statement ('else' statement)? | 'while' '(' expr ')' statement | 'do' statement 'while' '(' expr ')' ';' | 'for' '(' (local | expr_s (',' expr_s)*)? ';' expr? ';' (expr_s (',' expr_s)*)? ')' statement | 'for' '(' ('final' | annotation)* local_t 'IDENT' ':' expr ')' statement | switch | 'try' resources? block handler* ('finally' block)? | 'synchronized' '(' expr ')' block | 'throw' expr ';' | 'return' expr? ';' | 'break' 'IDENT'? ';' | 'continue' 'IDENT'? ';' | 'assert' expr (':' expr)? ';')",
    "switch": "'switch' '(' expr ')' '{' ((label ':')+ item* | label '->' (expr ';' | block | 'throw' expr ';'))* '}'",
    "label": "'case' cond (',' cond)* | 'default'",
    "resources": "'(' resource (';' resource)* ';'? ')'",
    "resource": "('final' | annotation)* local_t 'IDENT' '=' expr | expr",
    "handler": "'catch' '(' ('final' | annotation)* class_t ('|' class_t)* 'IDENT' ')' block",
    "expr_s": "('++' | '--') unary | primary post* (('++' | '--') | (" + _ASSIGN + " | '>' '>' '>=') assign)?",
    "expr": "assign",
    "assign": "unary ((" + _ASSIGN + " | '>' '>' '>=') assign | rest? ('?' expr ':' assign)?) | lambda",
    "rest": "(((" + _BINARY + " | '>' '>' '>') unary) | 'instanceof' 'final'? local_t 'IDENT'?)+",
    "cond": "unary rest? ('?' expr ':' cond)?",
    "unary": "('++' | '--' | '+' | '-' | '!' | '~') unary | '(' local_t ('&' class_t)* ')' (unary | lambda) | primary post* ('++' | '--')*",
    "lambda": "('IDENT' | '(' ('IDENT' (',' 'IDENT')* | params)? ')') '->' (expr | block)",
    "primary": "'IDENT' | 'NUM' | 'CHAR' | 'STR' | 'this' | 'super' | '(' expr ')' | 'new' (annotation* class_t '(' args? ')' class_b? | (basic | class_t) (('[' expr ']')+ ('[' ']')* | ('[' ']')+ '{' (init (',' init)*)? ','? '}')) | (local_t | 'void') '.' 'class' | class_t dims? '::' ('IDENT' | 'new') | basic dims '::' 'new' | switch",
    "post": "'[' expr ']' | '(' args? ')' | '.' (targs? 'IDENT' | 'this' | 'super' | 'class' | 'new' class_t '(' args? ')' class_b?) | '::' ('IDENT' | 'new')",
    "args": "expr (',' expr)*",
}

# File extensions of each language.
EXTENSIONS = {"c": "c", "h": "c", "cc": "cpp", "cpp": "cpp", "cxx": "cpp", "c++": "cpp", "hpp": "cpp", "hh": "cpp", "hxx": "cpp", "java": "java"}


@cache
def _parser(lang: str) -> tuple[Lexer, Language]:
    words, rules = {"c": (C_WORDS, C), "cpp": (CPP_WORDS, CPP), "java": (JAVA_WORDS, JAVA)}[lang]
    lexer = Lexer(words)
    return lexer, Language(rules, "unit", lexer.kinds)


def _one(text: str, lang: str) -> tuple[str | None, int]:
    lexer, language = _parser(lang)
    toks = lexer.tokens(text)
    at = language.run(toks)
    if at < 0:
        return None, -1
    return ("truncated" if at == len(toks) else "token"), at


def _all(text: str, lang: str) -> tuple[str | None, int]:
    """The problem of a text, of C and C++ in any branch of its conditionals."""
    if lang == "java" or "#" not in text:
        return _one(text, lang)
    parts = without_directives(text)
    if parts is None:
        return "directive", 0
    lines, found, ended = parts
    said: tuple[str | None, int] = None, -1
    for plain, valid in variants(lines, found):
        said = _one(plain, lang)
        valid(said[0] is None)
    return ("directive", 0) if said[0] is None and not ended else said


def check(text: str, lang: str) -> tuple[str | None, int]:
    """(None, -1) if the text is exactly one function definition with any branch of its preprocessor conditionals; else
    (truncated | token | directive, the place of the token that cannot stand where it does, counted without the branches
    not taken, or the number of tokens)."""
    said = _all(text, lang)
    if said[0] and lang == "cpp" and _all(text, "c")[0] is None:  # a C function in a C++ file is valid
        return None, -1
    return said
