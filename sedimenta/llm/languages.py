"""Which human language a text is in: letter trigrams of short sample texts, and scripts."""

from __future__ import annotations

import math
import re

import numpy as np

# Sample texts, written for this purpose. Their letter trigrams and words make up a language's profile.
SAMPLES = {
    "en": "The function reads the file first and then returns a value to the caller. All people are born free and equal, and everyone should act towards others in good faith. If you want to know what happens when the table is empty, check how it was created before you use it. This is why there is no need for more than one step, because they would have been too slow without it. Which of these could you explain to me? I think that we should not change their order after each call, so that it can still be used with what you have. Write a program that keeps the longest line.",
    "de": "Die Funktion liest zuerst die Datei und gibt danach einen Wert an den Aufrufer zurück. Alle Menschen sind frei und gleich geboren und sollen einander im Geist der Brüderlichkeit begegnen. Wenn man wissen will, was bei einer leeren Tabelle passiert, muss man prüfen, wie sie erstellt wurde. Das ist der Grund, warum nicht mehr als ein Schritt nötig ist, weil es sonst zu langsam wäre. Welche davon können Sie mir erklären? Ich denke, dass wir die Reihenfolge nach jedem Aufruf nicht ändern sollten, damit sie noch mit dem verwendet werden kann, was Sie haben. Außerdem wird der Speicher für große Eingaben zusätzlich überschrieben.",
    "fr": "La fonction lit d'abord le fichier et renvoie ensuite une valeur à celui qui l'appelle. Tous les êtres humains naissent libres et égaux et doivent agir les uns envers les autres dans un esprit de fraternité. Si l'on veut savoir ce qui se passe quand la table est vide, il faut vérifier comment elle a été créée avant de l'utiliser. C'est pourquoi il n'y a pas besoin de plus d'une étape, car ce serait trop lent sans cela. Lesquels pouvez-vous m'expliquer ? Je pense que nous ne devrions pas changer leur ordre après chaque appel, afin qu'il puisse encore être employé avec ce que vous avez. De plus, la mémoire est écrasée pour les grandes entrées.",
    "es": "La función primero lee el archivo y después devuelve un valor a quien la llama. Todos los seres humanos nacen libres e iguales y deben comportarse fraternalmente los unos con los otros. Si quieres saber qué pasa cuando la tabla está vacía, hay que comprobar cómo se creó antes de usarla. Por eso no hace falta más de un paso, porque sería demasiado lento sin él. ¿Cuáles de ellos me puedes explicar? Creo que no deberíamos cambiar su orden después de cada llamada, para que todavía se pueda utilizar con lo que tienes. Además, la memoria se sobrescribe cuando las entradas son grandes. Conviene ordenar el registro en general.",
    "it": "La funzione legge prima il file e poi restituisce un valore a chi la chiama. Tutti gli esseri umani nascono liberi ed eguali e devono agire gli uni verso gli altri in spirito di fratellanza. Se vuoi sapere che cosa succede quando la tabella è vuota, bisogna controllare come è stata creata prima di usarla. Ecco perché non serve più di un passo, perché sarebbe troppo lento senza. Quali di questi mi puoi spiegare? Penso che non dovremmo cambiare il loro ordine dopo ogni chiamata, così che si possa ancora utilizzare con quello che hai. Inoltre anche la memoria viene sovrascritta dalle richieste più grandi.",
    "pt": "A função lê primeiro o arquivo e depois devolve um valor a quem a chama. Todos os seres humanos nascem livres e iguais e devem agir uns para com os outros em espírito de fraternidade. Se você quer saber o que acontece quando a tabela está vazia, é preciso verificar como ela foi criada antes de usá-la. Por isso não há necessidade de mais de um passo, porque seria lento demais sem ele. Quais deles você pode me explicar? Acho que não deveríamos mudar a ordem depois de cada chamada, para que ainda possa ser usada com o que você tem. Além disso, a memória também é sobrescrita quando as entradas são grandes.",
    "nl": "De functie leest eerst het bestand en geeft daarna een waarde terug aan de aanroeper. Alle mensen worden vrij en gelijk geboren en behoren zich jegens elkaar in een geest van broederschap te gedragen. Als je wilt weten wat er gebeurt wanneer de tabel leeg is, moet je nagaan hoe die gemaakt werd voordat je hem gebruikt. Daarom is er niet meer dan één stap nodig, omdat het anders te langzaam zou zijn. Welke daarvan kunt u mij uitleggen? Ik denk dat we hun volgorde niet moeten wijzigen na elke oproep, zodat het nog steeds gebruikt kan worden met wat je hebt. Bovendien wordt ook het geheugen overschreven.",
    "pl": "Funkcja najpierw czyta plik, a potem zwraca wartość temu, kto ją wywołał. Wszyscy ludzie rodzą się wolni i równi i powinni postępować wobec innych w duchu braterstwa. Jeśli chcesz wiedzieć, co się dzieje, gdy tabela jest pusta, trzeba sprawdzić, jak została utworzona, zanim się jej użyje. Dlatego nie potrzeba więcej niż jednego kroku, ponieważ bez niego byłoby zbyt wolno. Które z nich możesz mi wyjaśnić? Myślę, że nie powinniśmy zmieniać ich kolejności po każdym wywołaniu, żeby można było jeszcze z niej korzystać. Ponadto pamięć jest nadpisywana przy dużych danych wejściowych.",
    "sv": "Funktionen läser först filen och lämnar sedan tillbaka ett värde till den som anropar den. Alla människor är födda fria och lika och bör handla gentemot varandra i en anda av broderskap. Om du vill veta vad som händer när tabellen är tom måste man kontrollera hur den skapades innan man använder den. Därför behövs det inte mer än ett steg, eftersom det annars skulle vara för långsamt. Vilka av dem kan du förklara för mig? Jag tycker att vi inte borde ändra deras ordning efter varje anrop, så att den ännu kan användas med det du har. Dessutom skrivs minnet över också.",
    "da": "Funktionen læser først filen og giver derefter en værdi tilbage til den, der kalder den. Alle mennesker er født frie og lige og bør handle mod hverandre i en broderskabets ånd. Hvis du vil vide, hvad der sker, når tabellen er tom, skal man undersøge, hvordan den blev oprettet, før man bruger den. Derfor er der ikke brug for mere end ét skridt, fordi det ellers ville være for langsomt. Hvilke af dem kan du forklare mig? Jeg synes ikke, at vi skulle ændre deres rækkefølge efter hvert kald, så den stadig kan bruges med det, du har. Desuden bliver hukommelsen også overskrevet.",
    "cs": "Funkce nejprve přečte soubor a potom vrátí hodnotu tomu, kdo ji zavolal. Všichni lidé se rodí svobodní a sobě rovní a mají spolu jednat v duchu bratrství. Když chcete vědět, co se stane, je-li tabulka prázdná, je třeba ověřit, jak byla vytvořena, než ji použijete. Proto není potřeba více než jeden krok, protože jinak by to bylo příliš pomalé. Které z nich mi můžete vysvětlit? Myslím, že bychom neměli měnit jejich pořadí po každém volání, aby se ještě dalo použít s tím, co máte. Kromě toho se také přepíše paměť při velkých vstupech.",
    "ro": "Funcția citește mai întâi fișierul și apoi întoarce o valoare celui care o apelează. Toate ființele umane se nasc libere și egale și trebuie să se comporte unele față de altele în spiritul fraternității. Dacă vrei să știi ce se întâmplă când tabelul este gol, trebuie verificat cum a fost creat înainte de a fi folosit. De aceea nu este nevoie de mai mult de un pas, pentru că altfel ar fi prea lent. Pe care dintre ele mi le poți explica? Cred că nu ar trebui să schimbăm ordinea lor după fiecare apel, astfel încât să mai poată fi folosită. În plus, și memoria este suprascrisă.",
    "tr": "İşlev önce dosyayı okur ve sonra onu çağırana bir değer döndürür. Bütün insanlar özgür ve eşit doğarlar ve birbirlerine karşı kardeşlik anlayışıyla davranmalıdırlar. Tablo boş olduğunda ne olduğunu bilmek istiyorsanız, kullanmadan önce nasıl oluşturulduğunu kontrol etmek gerekir. Bu yüzden bir adımdan fazlasına gerek yoktur, çünkü aksi halde çok yavaş olurdu. Bunlardan hangilerini bana açıklayabilirsiniz? Bence her çağrıdan sonra sıralarını değiştirmemeliyiz, böylece elinizdekiyle hâlâ kullanılabilir. Ayrıca büyük girdiler için bellek de yeniden yazılır.",
    "fi": "Funktio lukee ensin tiedoston ja palauttaa sitten arvon kutsujalle. Kaikki ihmiset syntyvät vapaina ja tasavertaisina, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jos haluat tietää, mitä tapahtuu, kun taulukko on tyhjä, on tarkistettava, miten se luotiin ennen kuin sitä käytetään. Siksi ei tarvita enempää kuin yksi askel, koska muuten se olisi liian hidasta. Mitkä niistä voit selittää minulle? Mielestäni meidän ei pitäisi muuttaa niiden järjestystä jokaisen kutsun jälkeen, jotta sitä voi yhä käyttää. Lisäksi muisti kirjoitetaan uudelleen.",
    "hu": "A függvény először beolvassa a fájlt, majd visszaad egy értéket annak, aki meghívta. Minden emberi lény szabadon születik és egyenlő, és egymással testvéri szellemben kell hogy viseltessenek. Ha tudni akarod, mi történik, amikor a táblázat üres, ellenőrizni kell, hogyan jött létre, mielőtt használod. Ezért nincs szükség egynél több lépésre, mert különben túl lassú lenne. Melyiket tudod nekem elmagyarázni közülük? Azt hiszem, nem kellene megváltoztatni a sorrendjüket minden hívás után, hogy még használni lehessen. Ezenkívül a memória is felülíródik.",
    "ru": "Функция сначала читает файл, а затем возвращает значение тому, кто её вызвал. Все люди рождаются свободными и равными и должны поступать в отношении друг друга в духе братства. Если вы хотите знать, что происходит, когда таблица пуста, нужно проверить, как она была создана, прежде чем её использовать. Поэтому не требуется больше одного шага, потому что иначе это было бы слишком медленно. Какие из них вы можете мне объяснить? Я думаю, что нам не следует менять их порядок после каждого вызова, чтобы его ещё можно было использовать.",
    "uk": "Функція спочатку читає файл, а потім повертає значення тому, хто її викликав. Усі люди народжуються вільними і рівними і повинні діяти у відношенні один до одного в дусі братерства. Якщо ви хочете знати, що відбувається, коли таблиця порожня, треба перевірити, як її було створено, перш ніж її використовувати. Тому не потрібно більше одного кроку, бо інакше це було б занадто повільно. Які з них ви можете мені пояснити? Я думаю, що нам не слід змінювати їхній порядок після кожного виклику.",
    "el": "Η συνάρτηση διαβάζει πρώτα το αρχείο και μετά επιστρέφει μια τιμή σε όποιον την κάλεσε. Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι και πρέπει να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης. Αν θέλετε να μάθετε τι συμβαίνει όταν ο πίνακας είναι κενός, πρέπει να ελέγξετε πώς δημιουργήθηκε πριν τον χρησιμοποιήσετε. Γι' αυτό δεν χρειάζονται περισσότερα από ένα βήματα, γιατί αλλιώς θα ήταν πολύ αργό.",
}
# Languages told by their script alone, with the first and last letter of its ranges.
SCRIPTS = {
    "he": (("֐", "׿"),),
    "ar": (("؀", "ۿ"),),
    "hi": (("ऀ", "ॿ"),),
    "th": (("฀", "๿"),),
    "ko": (("ᄀ", "ᇿ"), ("가", "힯")),
    "ja": (("぀", "ヿ"), ("一", "鿿")),
    "zh": (("一", "鿿"),),
}
# How the languages are called in English, German, French and Spanish.
NAMES = {
    "en": ("english", "englisch", "anglais", "inglés"),
    "de": ("german", "deutsch", "allemand", "alemán"),
    "fr": ("french", "französisch", "français", "francés"),
    "es": ("spanish", "spanisch", "espagnol", "español", "castellano"),
    "it": ("italian", "italienisch", "italien", "italiano"),
    "pt": ("portuguese", "portugiesisch", "portugais", "portugués"),
    "nl": ("dutch", "niederländisch", "néerlandais", "neerlandés"),
    "pl": ("polish", "polnisch", "polonais", "polaco"),
    "sv": ("swedish", "schwedisch", "suédois", "sueco"),
    "da": ("danish", "dänisch", "danois", "danés"),
    "cs": ("czech", "tschechisch", "tchèque", "checo"),
    "ro": ("romanian", "rumänisch", "roumain", "rumano"),
    "tr": ("turkish", "türkisch", "turc", "turco"),
    "fi": ("finnish", "finnisch", "finnois", "finlandés"),
    "hu": ("hungarian", "ungarisch", "hongrois", "húngaro"),
    "ru": ("russian", "russisch", "russe", "ruso"),
    "uk": ("ukrainian", "ukrainisch", "ukrainien", "ucraniano"),
    "el": ("greek", "griechisch", "grec", "griego"),
    "he": ("hebrew", "hebräisch", "hébreu", "hebreo"),
    "ar": ("arabic", "arabisch", "arabe", "árabe"),
    "hi": ("hindi",),
    "th": ("thai", "thailändisch", "thaï", "tailandés"),
    "ko": ("korean", "koreanisch", "coréen", "coreano"),
    "ja": ("japanese", "japanisch", "japonais", "japonés"),
    "zh": ("chinese", "chinesisch", "chinois", "chino"),
}
LANGUAGES = tuple(NAMES)
#: The most that one word may speak against a language, in nats.
MOST = 6.0
_ANY = re.compile(r"\b(?:" + "|".join(n for v in NAMES.values() for n in v) + r")")
_NAMED = {k: re.compile(r"\b(?:" + "|".join(v) + r")\w{0,2}\b") for k, v in NAMES.items()}
_WORDS = re.compile(r"[^\W\d_]+")


def _trigrams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + 3] for i in range(len(w) - 2)]


class Profiles:
    """Log-likelihood of words in each language, 0 for the likeliest and at least ``-MOST``; words are remembered."""

    def __init__(self, most_words: int = 300_000) -> None:
        self.most_words, self.known, self.rows = most_words, {}, np.zeros((1024, len(LANGUAGES)), dtype=np.float32)
        counts: dict[str, dict[str, int]] = {}
        self.lexicon: dict[str, set[str]] = {}
        for name, text in SAMPLES.items():
            words = _WORDS.findall(text.casefold())
            self.lexicon[name] = set(words)
            own = counts.setdefault(name, {})
            for w in words:
                for g in _trigrams(w):
                    own[g] = own.get(g, 0) + 1
        self.logs = {}
        for name, own in counts.items():
            total = sum(own.values()) + 0.1 * 20_000
            self.logs[name] = ({g: math.log((n + 0.1) / total) for g, n in own.items()}, math.log(0.1 / total))

    def vector(self, word: str) -> np.ndarray:
        out = np.full(len(LANGUAGES), -1e9, dtype=np.float32)
        scripts = [k for k, ranges in SCRIPTS.items() if any(a <= word[0] <= b for a, b in ranges)]
        if scripts:
            out[:] = -MOST * min(5.0, max(1.0, len(word) / 2))
            out[[LANGUAGES.index(k) for k in scripts]] = 0
            return out
        grams = _trigrams(word)
        for name, (log, rare) in self.logs.items():
            # a word of the sample counts beyond its trigrams
            out[LANGUAGES.index(name)] = sum(log.get(g, rare) for g in grams) + (3.0 if word in self.lexicon[name] else 0.0)
        return np.maximum(out - out.max(), -MOST)

    def sum(self, words: list[str]) -> np.ndarray:
        """The sum over casefolded words."""
        if len(self.known) > self.most_words:
            self.known.clear()
        known, at = self.known, []
        for w in words:
            i = known.get(w)
            if i is None:
                i = known[w] = len(known)
                if i == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.rows[i] = self.vector(w)
            at.append(i)
        return self.rows[at].sum(axis=0) if at else np.zeros(len(LANGUAGES), dtype=np.float32)


def named(low: str) -> set[int]:
    """Numbers of the languages that a casefolded text names."""
    return {LANGUAGES.index(k) for k, p in _NAMED.items() if p.search(low)} if _ANY.search(low) else set()
