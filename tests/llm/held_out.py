"""Pairs written by hand, with their defects: what people write, not what the test tables hold. None of them is trained on."""

CODE = [
    "def show(rows):\n    for line in rows:\n        print(line)", "class Timer:\n    def __init__(self, x, y):\n        self.x = x\n        self.y = y", "def limit():\n    return MAX_ROWS", "import os\n\nfor name in os.listdir('.'):\n    if name.endswith('.tmp'):\n        os.remove(name)\n",
    "def mean(xs):\n    if not xs:\n        return 0.0\n    return sum(xs) / len(xs)\n", "async def fetch(session, url):\n    async with session.get(url) as r:\n        r.raise_for_status()\n        return await r.json()", "x = [i * i for i in range(10)]\nprint(x)", "@app.route('/ping')\ndef ping():\n    return 'pong'",
    "SELECT name, age FROM users WHERE age > 30 ORDER BY age", "SELECT dept, AVG(salary)\nFROM staff\nGROUP BY dept\nHAVING AVG(salary) > 1000", "UPDATE users SET active = 0 WHERE last_login < '2019-01-01';", "CREATE TABLE t (id INT PRIMARY KEY, name TEXT);",
    "function debounce(fn, ms) {\n  let timer;\n  return (...args) => {\n    clearTimeout(timer);\n    timer = setTimeout(() => fn(...args), ms);\n  };\n}", "const add = (a, b) => a + b;", "export class Stack<T> {\n  private items: T[] = [];\n  push(x: T): void {\n    this.items.push(x);\n  }\n}",
    "package main\n\nimport \"fmt\"\n\nfunc main() {\n\tfmt.Println(\"hello\")\n}\n", "fn main() {\n    let v: Vec<i32> = (1..4).collect();\n    println!(\"{:?}\", v);\n}", "int gcd(int a, int b) {\n    while (b) {\n        int t = a % b;\n        a = b;\n        b = t;\n    }\n    return a;\n}", "def greet(name)\n  puts \"Hi, #{name}\"\nend",
    "for f in *.log; do\n  gzip \"$f\"\ndone", "#!/bin/sh\nset -eu\nmkdir -p build\ncd build && cmake ..\nmake -j4", "{\"name\": \"demo\", \"tags\": [\"a\", \"b\"], \"size\": {\"w\": 3}}", "<table>\n  <tr><td>1</td></tr>\n</table>", "def f(x): return x + 1",
    "```python\ndef area(r):\n    return 3.14159 * r ** 2\n```", "Use a set:\n\n```python\nseen = set()\nfor x in xs:\n    seen.add(x)\n```", "```js\nconsole.log([1, 2, 3].map(x => x * 2));\n```\n\nThis prints the doubled values.",
    "--- a/app.py\n+++ b/app.py\n@@ -3,4 +3,4 @@\n import os\n-DEBUG = True\n+DEBUG = False\n \n app = make()", "diff --git a/src/util.js b/src/util.js\n--- a/src/util.js\n+++ b/src/util.js\n@@ -1,4 +1,5 @@\n function f(a) {\n+  if (!a) return null;\n   return a.trim();\n }\n", "--- a/readme.md\n+++ b/readme.md\n@@ -1 +1,2 @@\n # Title\n+More text.",
    "public class Main {\n    public static void main(String[] args) {\n        System.out.println(\"done\");\n    }\n}", "try:\n    value = int(text)\nexcept ValueError:\n    value = None",
]
PROSE = [
    ("What is the capital of France?", "Paris is the capital, and it lies on the Seine."), ("What does HTTP 403 mean?", "It means that the server understood the request but you are not allowed to share or view the resource. Check the permissions of your account."),
    ("Why is the sky blue?", "Air scatters short waves more than long ones. Blue light is therefore spread over the whole sky."), ("How do I undo a commit?", "Run `git revert` with the hash of the commit. It creates a new commit that undoes the old one."),
    ("Can I cancel the order?", "Unfortunately, orders cannot be cancelled after dispatch. You can return the parcel within 30 days, though."), ("Name three planets.", "1. Mars\n2. Venus\n3. Saturn"), ("What is 7 times 8?", "56"), ("Is Python typed?", "Yes, dynamically."), ("Which port does ssh use?", "22"), ("Who wrote Faust?", "Goethe"),
    ("Give me a slogan for a bakery.", "Fresh every morning"), ("What is a mutex?", "A lock that only one thread can hold at a time. Others wait until it is released."), ("Summarise the report.", "Sales rose by four percent, mainly in the north. Costs stayed flat."), ("How long does it take?", "About three hours, depending on the size of the files."),
    ("Was ist ein Primzahlsatz?", "Er beschreibt, wie häufig Primzahlen unter großen Zahlen vorkommen. Je größer die Zahlen, desto seltener sind sie."), ("Comment fait-on du pain ?", "On mélange la farine, l'eau, le sel et la levure. Puis on laisse reposer la pâte avant de la cuire."), ("¿Qué es una base de datos?", "Es un conjunto ordenado de datos que se puede consultar y modificar. Casi todas usan tablas."),
    ("Translate 'good morning' into German.", "Guten Morgen, ich wünsche Ihnen einen schönen Tag."), ("Schreibe einen Satz auf Englisch über Katzen.", "Cats like to sleep in the sun and rarely come when they are called."), ("Co to jest kompilator?", "To program, który tłumaczy kod źródłowy na kod maszynowy. Dzięki temu komputer może go wykonać."), ("Что такое процессор?", "Это часть компьютера, которая выполняет команды программы. Чем он быстрее, тем быстрее работает система."), ("Che cos'è un algoritmo?", "È una serie di istruzioni che risolve un problema in un numero finito di passi."),
    ("What should the bot say?", "Say that you are sorry and cannot find the order, then ask for the number again."), ("Can I use this without a licence?", "No, you need one for commercial use. For private use it is free."), ("How do I decline an invitation?", "Thank the host, say that you cannot come, and wish them a good evening."), ("Why can't I log in?", "Your account may be locked. I would reset the password first; if that does not help, ask the administrator to unlock it."),
    ("List two fruits.", "- apples\n- pears"), ("What is a closure?", "## Closures\n\nA closure is a function together with the variables it can see where it was made."), ("Explain the error.", "The index is out of range: the list has three items, but the loop runs to four."), ("How does photosynthesis work?", "Plants turn light, water and carbon dioxide into sugar and oxygen. This takes place in the leaves."),
]
REFUSED = [
    "Nope, not going to do that.", "I'd prefer to leave that unanswered.", "I can't help with that one, sorry.", "Sorry, this isn't something I'm comfortable answering.", "I am unable to provide an answer to that question.", "My guidelines prevent me from responding to this.", "I must respectfully decline.", "As an AI model, I am not able to assist with such requests.",
    "I won't answer this question.", "Unfortunately I'm not permitted to share this information. Please ask someone else.", "I apologize, but I can't write that.", "That request is not something I will fulfil.", "I'm going to have to decline that. Is there something else I can help you with?", "I do not wish to answer that.", "I refuse to help with this.", "Leider darf ich diese Frage nicht beantworten.",
    "Tut mir leid, dabei kann ich Ihnen nicht helfen.", "Ich muss das leider ablehnen.", "Désolé, je ne peux pas répondre à cela.", "Je suis dans l'obligation de refuser cette demande.", "Lo siento, no puedo contestar a esa pregunta.", "Me temo que debo rechazar esta petición.", "I'm afraid I cannot comply with this request.", "Regrettably, I am not in a position to answer this.",
]
FOREIGN = [
    ("What is a compiler?", "To program, który tłumaczy kod źródłowy na kod maszynowy. Dzięki temu komputer może go wykonać."), ("Explain what a processor does.", "Это часть компьютера, которая выполняет команды программы. Чем он быстрее, тем быстрее работает система."), ("How do I bake bread?", "On mélange la farine, l'eau, le sel et la levure. Puis on laisse reposer la pâte avant de la cuire."),
    ("What is a database?", "Es un conjunto ordenado de datos que se puede consultar y modificar. Casi todas usan tablas."), ("Describe the prime number theorem.", "Er beschreibt, wie häufig Primzahlen unter großen Zahlen vorkommen. Je größer die Zahlen, desto seltener sind sie."), ("What is an algorithm?", "È una serie di istruzioni che risolve un problema in un numero finito di passi."), ("Wie macht man Brot?", "You mix flour, water, salt and yeast. Then you let the dough rest before you bake it."),
    ("Was ist eine Datenbank?", "Es un conjunto ordenado de datos que se puede consultar y modificar."), ("Pourquoi le ciel est-il bleu ?", "Air scatters short waves more than long ones. Blue light is therefore spread over the whole sky."), ("¿Por qué el cielo es azul?", "Weil die Luft kurze Wellen stärker streut als lange. Darum sehen wir überall blaues Licht."), ("Explain what a queue is.", "キューは先に入れたものを先に取り出すデータ構造です。"), ("What is the sun made of?", "太阳主要由氢和氦组成，表面温度约为五千五百摄氏度。"),
    ("How does a lock work?", "Μια κλειδαριά ανοίγει μόνο με το σωστό κλειδί, γιατί οι πείροι πρέπει να ευθυγραμμιστούν."), ("What is a firewall?", "Een firewall controleert het verkeer tussen netwerken en blokkeert wat niet is toegestaan."), ("Why do leaves fall?", "Bladen faller eftersom trädet sparar vatten under vintern. De växer ut igen på våren."), ("What is inflation?", "A inflação é o aumento geral dos preços. Ela reduz o poder de compra da moeda."), ("Why is the sea salty?", "Deniz tuzludur çünkü nehirler kayalardan çözünen tuzları denize taşır."), ("Explain gravity.", "الجاذبية هي القوة التي تجذب الأجسام نحو بعضها البعض."),
]
CUT = [
    ("What is the capital of France?", "Paris is the capital, and it lies on the"), ("Why is the sky blue?", "Air scatters short waves more than long ones. Blue light is therefore spre"), ("How do I undo a commit?", "Run `git revert` with the hash of the commit. It creates a new"), ("What is a mutex?", "A lock that only one thread can hold at a time. Others wait until"), ("Summarise the report.", "Sales rose by four percent, mainly in the north. Costs..."),
    ("Comment fait-on du pain ?", "On mélange la farine, l'eau, le sel et la levure. Puis on laisse reposer la"), ("Was ist ein Primzahlsatz?", "Er beschreibt, wie häufig Primzahlen unter großen Zahlen vorkommen. Je größer die"), ("¿Qué es una base de datos?", "Es un conjunto ordenado de datos que se puede consultar y"), ("Explain the error.", "The index is out of range: the list has three items, but the"), ("How does photosynthesis work?", "Plants turn light, water and carbon dioxide into sugar and oxy"),
    ("Write code.", "def mean(xs):\n    if not xs:\n        return 0.0\n    return sum(xs) / len("), ("Write code.", "import os\n\nfor name in os.listdir('.'):\n    if name.ends"), ("Write code.", "class Timer:\n    def __init__(self, x, y):\n        self.x ="), ("Write code.", "SELECT dept, AVG(salary)\nFROM staff\nGROUP BY dept\nHAVING AVG("), ("Write code.", "function debounce(fn, ms) {\n  let timer;\n  return (...args) => {\n    clearTimeout(timer);"), ("Write code.", "package main\n\nimport \"fmt\"\n\nfunc main() {\n\tfmt.Prin"),
    ("Write code.", "int gcd(int a, int b) {\n    while (b) {\n        int t = a % b;"), ("Write code.", "{\"name\": \"demo\", \"tags\": [\"a\", \"b\"], \"size\": {\"w\":"), ("Write code.", "```python\ndef area(r):\n    return 3.14"), ("Write code.", "Use a set:\n\n```python\nseen = set()\nfor x in xs:"), ("Write code.", "fn main() {\n    let v: Vec<i32> = (1..4).coll"), ("Write code.", "public class Main {\n    public static void main(String[] args) {\n        System.out."), ("Write code.", "def greet(name)\n  puts \"Hi, #{na"), ("Write code.", "for f in *.log; do\n  gzip \"$f"),
]
NOTHING = ["", " \n ", "...", "—", "N/A", "[no answer]", "(to be done)", "TBD", "## Solution", "Answer:", "<p></p>", "```\n```", "No response.", "Response missing.", "**Result:**", "<div><br/></div>", "[empty]", "no answer available", "# Explanation", "(keine Antwort)", "\u200b", "&nbsp;&nbsp;"]
SAID_AGAIN = [q for q, _ in PROSE[:3] + PROSE[14:17]] + ["Question: " + q for q, _ in PROSE[3:6]] + ["> " + q for q, _ in PROSE[5:7]] + [q.upper() for q, _ in PROSE[11:14]]
ECHOED = [(q, a) for a in SAID_AGAIN for q, _ in PROSE if "".join(filter(str.isalnum, q)).casefold() in "".join(filter(str.isalnum, a)).casefold()]

CASES = (
    [("Write the code that is asked for.", c, None) for c in CODE]
    + [(q, a, None) for q, a in PROSE]
    + [(PROSE[i % len(PROSE)][0] if i < 15 or i > 21 else ["Warum ist das so?", "Was ist das?", "Kannst du mir helfen?", "Pourquoi ?", "Que se passe-t-il ici ?", "¿Por qué pasa esto?", "¿Qué hace esta función?"][i - 15], a, "refusal") for i, a in enumerate(REFUSED)]
    + [(q, a, "other_language") for q, a in FOREIGN]
    + [(q, a, "truncated") for q, a in CUT]
    + [("How do I write a loop in Python?", a, "empty") for a in NOTHING]
    + [(q, a, "copies_question") for q, a in ECHOED]
)
