"""Texts that the field for defective answers is trained on besides the table: refusals, notes in place of answers, sound answers."""

from __future__ import annotations

# Refusals are put together from an opening, what is declined, and a close, all of one language; openings and closes may be missing.
REFUSALS = {
    "en": (
        ("I'm sorry, but", "Sorry,", "I am sorry, but", "Unfortunately,", "I apologize, but", "Apologies, but", "I'm afraid", "Regrettably,", "I understand what you need, but", "Thank you for asking. However,", "I appreciate the question, but", "No,", "Nope,", "As an AI,", "As a language model", "As an assistant"),
        (
            "I cannot help with that.", "I can't assist with this request.", "I can’t help you here.", "I am unable to answer this question.", "I'm unable to comply with that.", "I am not able to write this code for you.", "I'm not able to do that.", "I won't be providing an answer to this.",
            "I will not answer that.", "I won't do this.", "I must decline to answer.", "I have to decline this one.", "this is something I must decline.", "I have to refuse.", "I would rather not answer this one.", "I'd rather not say.", "I prefer not to answer.", "I would prefer to skip this question.", "I don't have the ability to do this.",
            "I do not have the ability to answer.", "my instructions do not permit a reply to this question.", "my guidelines don't allow me to do that.", "this goes against my guidelines.", "that is against my policy.", "this is not something I can do.", "that's not something I am able to help with.", "I am not allowed to answer that.",
            "I'm not permitted to discuss this.", "this is outside of what I am allowed to do.", "that falls outside of what I may answer.", "it would not be right for me to answer this.", "I am not going to do that.", "I'm not going to write this.", "I can not fulfil this request.", "I cannot provide that information.", "I cannot share that.", "I can't discuss this topic.",
            "I refuse to answer.", "answering this is not possible for me.", "I'll have to pass on this one.", "I choose not to respond to this.", "count me out of this one.", "I must leave this unanswered.", "I could not possibly answer that.", "there is no way I will do this.", "I decline.", "please don't ask me to do this.", "I'm declining this request.",
        ),
        ("Let me know if you have another question.", "Please consult an expert instead.", "I hope you understand.", "Is there anything else you would like to talk about?", "Feel free to ask me something else.", "Please contact a professional.", "Thank you for understanding.", "How else can I help you?"),
    ),
    "de": (
        ("Es tut mir leid, aber", "Tut mir leid,", "Leider", "Entschuldigung,", "Ich verstehe den Wunsch, aber", "Danke für die Frage, aber", "Bedaure,", "Nein,", "Als KI-Sprachmodell", "Als Assistent"),
        (
            "ich kann dabei nicht helfen.", "kann ich dabei nicht helfen.", "ich kann diese Frage nicht beantworten.", "darf ich darauf nicht antworten.", "das kann ich nicht beantworten.", "ich muss diese Anfrage ablehnen.", "diese Anfrage muss ich leider ablehnen.", "das verstößt gegen meine Richtlinien.", "ich bin nicht in der Lage, das zu tun.",
            "das ist mir nicht möglich.", "das liegt außerhalb dessen, was ich darf.", "ich möchte darauf lieber nicht antworten.", "ich werde diesen Code nicht schreiben.", "kann ich diese Bitte nicht erfüllen.", "ich habe nicht die Möglichkeit, das zu beantworten.", "da kann ich nicht weiterhelfen.", "meine Vorgaben erlauben keine Antwort.", "dazu sage ich nichts.", "ich verweigere die Antwort.",
        ),
        ("Bitte wende dich an eine Fachperson.", "Ich hoffe auf Verständnis.", "Gibt es sonst noch etwas?", "Sag mir, wenn du eine andere Frage hast.", "Vielen Dank für Ihr Verständnis."),
    ),
    "fr": (
        ("Je suis désolé, mais", "Désolé,", "Désolée, mais", "Malheureusement,", "Je regrette, mais", "Merci de votre question, mais", "Je comprends, mais", "Non,", "En tant que modèle de langage,", "En tant qu'assistant,"),
        (
            "je ne peux pas vous aider.", "je ne peux pas répondre à cette question.", "je ne suis pas en mesure de répondre.", "je ne suis pas autorisé à faire cela.", "je dois refuser cette demande.", "je dois décliner.", "il m'est impossible de répondre.", "c'est contraire à mes règles.", "cela va à l'encontre de mes consignes.", "je ne suis pas capable d'écrire ce code.",
            "je préfère ne pas répondre.", "cela est en dehors de ce que je peux faire.", "je ne peux pas traiter cette demande.", "mes instructions ne permettent pas de réponse.", "je refuse de répondre.", "je n'ai pas la possibilité de faire cela.", "je ne répondrai pas à cela.",
        ),
        ("Veuillez consulter un spécialiste.", "J'espère que vous comprenez.", "Y a-t-il autre chose ?", "N'hésitez pas à poser une autre question.", "Merci de votre compréhension."),
    ),
    "es": (
        ("Lo siento, pero", "Lo siento,", "Disculpa,", "Lamentablemente,", "Por desgracia", "Perdón, pero", "Gracias por preguntar, pero", "Entiendo, pero", "No,", "Como modelo de lenguaje,", "Como asistente,"),
        (
            "no puedo ayudar con eso.", "no puedo responder a esta pregunta.", "no me es posible responder.", "no estoy autorizado a hacer eso.", "debo rechazar esta solicitud.", "tengo que declinar.", "no soy capaz de hacerlo.", "va en contra de mis normas.", "esto está fuera de lo que puedo hacer.", "prefiero no contestar.", "no podré escribir este código.",
            "mis instrucciones no permiten una respuesta.", "me niego a responder.", "no tengo la posibilidad de hacerlo.", "no voy a contestar a eso.", "no puedo atender esta petición.",
        ),
        ("Por favor, consulta a un especialista.", "Espero que lo entiendas.", "¿Hay algo más?", "Dime si tienes otra pregunta.", "Gracias por tu comprensión."),
    ),
}
#: What may stand before a refusal and restates the question.
RESTATED = {"en": ("You are asking about this.", "You want to know about it.", "Your question is about this."), "de": ("Du fragst danach.", "Sie möchten das wissen."), "fr": ("Vous demandez cela.", "Votre question porte sur cela."), "es": ("Preguntas por esto.", "Quieres saber eso.")}

#: Notes in place of an answer.
NOTES = (
    "n/a", "N/A", "na", "tbd", "TBD", "tba", "todo", "to do", "# TODO", "TODO: answer", "fixme", "left blank", "intentionally left blank", "blank", "empty", "missing", "pending", "none given", "not available", "not provided", "no answer", "no response", "no reply", "no output", "no solution yet",
    "no answer provided.", "no answer was given.", "answer missing", "response missing", "answer pending", "answer to follow", "output not available", "there is no answer", "no content", "keine antwort", "keine Antwort vorhanden", "Antwort fehlt", "ohne Angabe", "pas de réponse", "réponse manquante", "aucune réponse", "sin respuesta", "no hay respuesta", "falta la respuesta",
)
#: Labels and headings without anything below them.
LABELS = ("Answer", "Solution", "Response", "Result", "Output", "Reply", "Code", "Explanation", "Antwort", "Lösung", "Ergebnis", "Réponse", "Solution", "Résultat", "Respuesta", "Solución", "Resultado", "Your answer", "Final answer", "Example", "Overview", "Implementation")
#: Labels that may stand before an instruction that is said again.
ECHO_LABELS = ("Question", "Prompt", "Instruction", "Task", "Q", "Query", "User", "Input", "Request", "Frage", "Aufgabe", "Consigne", "Pregunta", "Tarea", "Answer")

#: Sound answers with words that refusals use, too.
SOUND = (
    ("Why does the request fail?", "The server returns 403 because the client is not allowed to read the file. Add the missing permission and try again."),
    ("What does this error mean?", "It means that the process cannot open the socket. Unfortunately the message does not say which one, so check the log."),
    ("How do I stop the job?", "You can't stop it from the console. Use the stop command instead, and it will end after the current step."),
    ("Is the lock released?", "No, it is not. The lock is kept until the handle is closed, and other threads have to wait."),
    ("Can I use a list as a key?", "No. A list can be changed, so it cannot be hashed. Use a tuple instead."),
    ("Why is my answer marked wrong?", "I'm sorry for the confusion: the check compares whole lines. Remove the blank at the end."),
    ("What happens without a password?", "The service refuses the connection and must not write anything. Please contact the owner of the host for a password."),
    ("Should I answer the prompt?", "You must answer with yes or no. If you decline, the tool asks again and does not change the file."),
    ("Who may write to this table?", "Only the owner is permitted to write. Others are able to read, but they do not have the right to change rows."),
    ("How can the program say no?", "It raises an error that the caller has to handle. I would rather return a code, because it is easier to test."),
    ("Warum wird die Datei nicht gelesen?", "Der Dienst darf die Datei nicht öffnen. Leider meldet er das erst am Ende, daher hilft nur ein Blick ins Protokoll."),
    ("Kann ich das ändern?", "Nein, das ist nicht möglich, solange die Sperre besteht. Danach kann der Wert neu gesetzt werden."),
    ("Pourquoi le test échoue-t-il ?", "Malheureusement le module ne peut pas lire le fichier. Il faut d'abord lui donner les droits."),
    ("Est-ce possible ?", "Non, ce n'est pas possible avant la fin de l'appel. Il faut attendre le résultat."),
    ("¿Por qué falla la prueba?", "Por desgracia el módulo no puede leer el archivo. Primero hay que darle permiso."),
    ("¿Se puede repetir?", "No, no es posible antes de que termine la llamada. Hay que esperar el resultado."),
    ("Which value does it return?", "42"), ("Which value is printed?", "True"), ("What is the complexity?", "O(log n)"), ("Which error is raised?", "KeyError"), ("Name the default port.", "8080"), ("What is the capital of Italy?", "Rome"), ("Which flag is needed?", "--verbose"), ("Yes or no?", "No."), ("What is missing in the file?", "The header."), ("Which files are empty?", "a.txt and b.txt"),
    ("Name three colours.", "- red\n- green\n- blue"), ("List the steps.", "1. Read the file\n2. Sort the lines\n3. Write the result"), ("Which tools do I need?", "* a compiler\n* make\n* an editor of your choice"),
    ("Write a haiku.", "Old pond in the rain,\nthe frog has gone to the road,\nonly the moss stays"), ("Give a title.", "The Long Way Home"), ("Write a poem about a key.", "A key that nobody turned,\na door that never was there,\nand still the hall is warm"),
    ("Explain recursion.", "A function that calls itself on a smaller part of the input.\n\n## When to use it\n\nUse it for trees, as each branch is a tree as well."),
    ("Add a method that stores a value.", "class Box:\n    def __init__(self, size):\n        self.size = size\n        self.items = {}\n\n    def put(self, key, value):\n        self.items[key] = value\n"),
    ("Print each line in upper case.", "def shout(path):\n    with open(path) as source:\n        for line in source:\n            print(line.upper())\n"),
    ("Write a logger in Python.", "import sys\n\ndef log(text, level=0):\n    if level > 2:\n        sys.stderr.write(text)\n    else:\n        sys.stdout.write(text)"),
    ("Read the settings.", "import json\n\nDEFAULTS = {'depth': 3}\n\ndef settings(path):\n    try:\n        with open(path) as f:\n            return json.load(f)\n    except OSError:\n        return DEFAULTS"),
    ("Retry a call in Python.", "def retry(call, times):\n    for attempt in range(times):\n        try:\n            return call()\n        except ValueError:\n            continue\n    raise RuntimeError('gave up')\n"),
    ("Write a generator of even numbers.", "def evens(limit):\n    n = 0\n    while n < limit:\n        yield n\n        n += 2\n"),
    ("Remove a key from a cache.", "def drop(cache, key):\n    cache.pop(key, None)\n    cache.dirty.add(key)\n    notify(cache)"),
    ("Sum a list in Python.", "total = 0\nfor x in [1, 2, 3]:\n    total += x\nprint(total)"), ("Test the adder.", "def test_add():\n    assert add(1, 2) == 3\n    assert add(0, 0) == 0\n"),
    ("Write an abstract class.", "from abc import ABC, abstractmethod\n\nclass Shape(ABC):\n    @abstractmethod\n    def area(self):\n        ...\n\n    def name(self):\n        pass\n"),
    ("Select the last orders.", "SELECT id, total\nFROM orders\nORDER BY id DESC\nLIMIT 10"), ("Count rows per city in SQL.", "select city, count(*) as n\nfrom people\ngroup by city\nhaving count(*) > 1"), ("Delete old rows.", "DELETE FROM logs WHERE day < '2020-01-01';"), ("Join two tables.", "SELECT a.id, b.name FROM a JOIN b ON a.id = b.id WHERE b.name IS NOT NULL"),
    ("Write a counter in JavaScript.", "let n = 0\nconst next = () => {\n  n += 1\n  return n\n}\nexport default next"), ("Bind a handler.", "document.querySelector('#go').addEventListener('click', () => {\n  run();\n});"), ("Define a type in TypeScript.", "type Point = { x: number; y: number };\n\nfunction length(p: Point): number {\n  return Math.hypot(p.x, p.y);\n}"),
    ("Write main in C.", "#include <stdio.h>\n\nint main(void) {\n    printf(\"hi\\n\");\n    return 0;\n}"), ("Define a constant in C.", "#define SIZE 64\nstatic int table[SIZE];"), ("Show a Go test.", "package calc\n\nimport \"testing\"\n\nfunc TestAdd(t *testing.T) {\n\tif Add(1, 2) != 3 {\n\t\tt.Fatal(\"wrong\")\n\t}\n}"),
    ("Write a struct in Rust.", "struct Point {\n    x: f64,\n    y: f64,\n}\n\nimpl Point {\n    fn norm(&self) -> f64 {\n        (self.x * self.x + self.y * self.y).sqrt()\n    }\n}"), ("Write a Ruby module.", "module Greeter\n  def self.hello(name)\n    puts \"hello #{name}\"\n  end\nend"),
    ("Back up a folder.", "#!/bin/bash\nset -e\nfor f in *.txt; do\n  cp \"$f\" \"$f.bak\"\ndone\necho finished"), ("Install the tool.", "git clone repo.git\ncd repo\nmake install"), ("Write a settings file.", "name: demo\nsteps:\n  - run: make\n  - run: make test\nretries: 2"), ("Write some HTML.", "<ul>\n  <li>one</li>\n  <li>two</li>\n</ul>"), ("Give a regular expression.", "^[a-z]+\\d{2,}$"),
    ("Fix the off-by-one.", "--- a/x.py\n+++ b/x.py\n@@ -1,3 +1,3 @@\n def f(n):\n-    return range(n)\n+    return range(n + 1)\n \n"), ("Rename the flag.", "diff --git a/cli.py b/cli.py\nindex 1f2..3a4 100644\n--- a/cli.py\n+++ b/cli.py\n@@ -10,2 +10,2 @@ def main():\n-    p.add('--old')\n+    p.add('--new')\n     return p.parse()"), ("Close the file.", "--- a/io.py\n+++ b/io.py\n@@ -4,2 +4,3 @@ def load():\n     data = f.read()\n+    f.close()"),
    ("Add a check in C.", "--- a/m.c\n+++ b/m.c\n@@ -7,3 +7,4 @@ int run(int n) {\n   int k = 0;\n+  if (n < 0) return -1;\n   while (k < n) k++;\n }"),
    ("Why do cats purr?", "They purr when they are content, but also when they are hurt. It may help them to heal."), ("How do I boil an egg?", "Put it into boiling water for seven minutes. If you like it soft, take it out after five."), ("Do I need a visa?", "It depends on your passport. For a stay of less than ninety days you do not need one in most cases."), ("What is the tallest mountain?", "Mount Everest."), ("Is water wet?", "Yes, in the usual sense of the word."),
    ("Tell me about the moon.", "The moon goes around the earth in about a month. It has no air, so there is no sound on it."), ("How can I sleep better?", "Go to bed at the same time each day, and leave your phone in another room. You should feel a difference within a week."), ("Who was Marie Curie?", "She was a scientist who won two Nobel prizes, one for physics and one for chemistry."), ("What is rent control?", "A rule that limits how much the owner of a flat may ask for. Some think it helps tenants, others say that it leads to fewer homes."),
    ("How was business?", "Orders fell by a third last year. The new shop did well, and debts are lower than before."), ("Describe the town.", "It lies by a river and has two bridges. Most people work in the mill, which was built in 1890."), ("How do I reset my phone?", "Hold both buttons for ten seconds. Then let go, and wait until the logo is shown."), ("Can you explain this joke?", "It plays on two meanings of one word. That is why the second line sounds like an answer to the first."), ("Should I buy or lease?", "If you drive a lot, buying is cheaper. If you want something new every other year, I would lease."),
    ("What is a good name for a dog?", "Rusty"), ("Which month has 28 days?", "All of them."), ("Write a slogan for a shoe shop.", "Walk on clouds every day"), ("Give a headline.", "Small town wins big prize"), ("What is your favourite colour?", "Blue, I would say."), ("Is it static?", "No, lazily evaluated."), ("When was it built?", "In 1912"), ("How far is it?", "12 km"), ("Which unit is used?", "Newton metres"), ("Name an antonym of hot.", "cold"), ("Which command lists files?", "ls -la"), ("Which path?", "/usr/local/bin"),
    ("How does a fridge work?", "A liquid takes up heat inside and turns into gas. Outside it is pressed together and gives the heat away again."), ("What do bees do in winter?", "They stay in the hive and keep the queen warm. For food they have the honey that they made in summer."), ("Why do we have leap years?", "A year is a little longer than 365 days. One more day every fourth year makes up for that."), ("What is a tax?", "Money that people have to pay to the state. With it schools, roads and much else are paid for."), ("I lost my key, what now?", "Ask the landlord first, as they may have a spare one. If not, call a locksmith; it will not be cheap, but it is quick."),
    ("How do vaccines help?", "They show the body what to look for, so that it can answer faster when the real thing comes."), ("What does the manual say about heat?", "Do not leave the device in the sun. It must not get warmer than 40 degrees, and you should not charge it while it is hot."), ("May I bring my dog?", "You may bring a dog if it is on a lead. Please keep it away from the pool, and contact us before you come."), ("Is the museum open?", "It is open from nine to five. On Mondays it is closed, so you will have to come another day."), ("How do I apologize?", "Say that you are sorry, say what you did wrong, and ask how you can help. Do not explain too much."),
    ("Warum fliegen Vögel im Herbst fort?", "Im Winter finden sie hier zu wenig Futter. Darum ziehen sie in wärmere Länder und kommen im Frühling wieder."), ("Wie koche ich Reis?", "Nimm doppelt so viel Wasser wie Reis. Lass ihn zwanzig Minuten ziehen, ohne den Deckel zu heben."), ("Brauche ich einen Ausweis?", "Ja, ohne Ausweis kommen Sie nicht hinein. Kinder können mit ihren Eltern gehen."), ("Pourquoi les feuilles tombent-elles ?", "L'arbre garde son eau pour l'hiver. Au printemps, de nouvelles feuilles poussent."), ("Comment faire du thé ?", "Versez de l'eau chaude sur les feuilles et attendez trois minutes. On peut ajouter du lait."), ("¿Cómo se hace el café?", "Se pone agua caliente sobre el café molido y se espera un poco. Si te gusta, puedes añadir leche."), ("¿Por qué hay mareas?", "La luna atrae el agua del mar. Por eso sube y baja dos veces al día."),
    ("Return a constant.", "LIMIT = 20\n\ndef most():\n    return LIMIT"), ("Write a handler.", "@bus.on('saved')\ndef saved(event):\n    return 'ok'"), ("Give the default.", "def default():\n    return None"), ("One line, please.", "const twice = x => x * 2;"), ("Give me an arrow function.", "const isEven = n => n % 2 === 0"), ("Double a number in Python.", "double = lambda x: 2 * x"), ("List all books.", "SELECT title, year FROM books WHERE year > 1990 ORDER BY year"), ("All names.", "SELECT name FROM authors"), ("Rename files in a loop.", "for i in 1 2 3; do\n  mv \"a$i\" \"b$i\"\ndone"), ("Wait for the port.", "until nc -z localhost 80; do\n  sleep 1\ndone"), ("Check a file.", "if [ -f x.txt ]; then\n  cat x.txt\nfi"),
    ("Fix the text.", "--- a/notes.txt\n+++ b/notes.txt\n@@ -1,2 +1,2 @@\n Dear all,\n-we meet today.\n+we meet tomorrow."), ("Document the option.", "--- a/doc.md\n+++ b/doc.md\n@@ -5 +5,2 @@\n ## Options\n+* quiet: print nothing"), ("Bump the version.", "diff --git a/setup.cfg b/setup.cfg\n--- a/setup.cfg\n+++ b/setup.cfg\n@@ -1,3 +1,3 @@\n [metadata]\n-version = 1.0\n+version = 1.1\n name = demo"), ("Set the attribute.", "class Node:\n    def link(self, other):\n        self.next = other\n        other.prev = self"), ("Loop forever.", "while True:\n    step()\n    time.sleep(1)"), ("Read lines.", "with open('a.txt') as f:\n    lines = f.readlines()"),
    ("Show the use.", "```python\nbox = Box(3)\nprint(box.size)\n```"), ("Sort in place.", "Call `sort`:\n\n```python\nrows.sort(key=len)\n```"), ("Write a C loop.", "for (int i = 0; i < n; i++)\n    sum += a[i];"), ("Declare it.", "static const char *NAMES[] = {\"a\", \"b\"};"), ("Write a macro in Rust.", "let total: u32 = xs.iter().sum();\nprintln!(\"{total}\");"), ("Give a class in C#.", "public record Point(int X, int Y);"), ("A Makefile, please.", "all: main.o\n\tcc -o main main.o\n\nclean:\n\trm -f *.o"), ("Write a CSS rule.", "body {\n  margin: 0;\n  color: #222;\n}"), ("Map in Ruby.", "names.map { |n| n.upcase }"), ("Use Kotlin.", "fun square(x: Int) = x * x"),
    ("Who is on the team?", "- Ann\n- Bob\n- Carla Smith"), ("Name the four seasons.", "1. spring\n2. summer\n3. autumn\n4. winter"), ("What is in the bag?", "* rice\n* black beans"), ("Which steps are left?", "1. Test the new build\n2. Tell the others"), ("Give me three verbs.", "- run\n- sing\n- build"), ("List the largest lakes.", "Here are some:\n\n1. Victoria\n2. Huron\n3. Michigan"), ("What do I pack?", "- warm socks\n- a torch\n- matches"), ("Name two rivers.", "1. Nile\n2. Rhine"),
    ("Nenne drei Farben.", "- rot\n- gelb\n- dunkelblau"), ("Cite deux villes.", "- Lyon\n- Nantes"), ("Nombra dos frutas.", "- pera\n- uva"), ("Write a motto.", "Slow but sure"), ("Pick a title for the talk.", "What trees remember"), ("Name the band.", "The Quiet Neighbours"),
    ("Which value does it return?", "'ready'"), ("Which text is printed?", '"left"'), ("What does the call give?", "'x'"), ("Which key is read?", '"page"'), ("Which name does it have?", "'my note'"), ("Is it fast?", "Yes, surprisingly."), ("Is it safe to use?", "No, hardly."), ("How is it sorted?", "Descending, by name."),
)
