"""Fixed values the operators must agree on. Nothing in this file is logic."""

# Stopwords of 21 languages, by two-letter language code. Other languages are
# supplied as a (lang, word) table, see sources.files.read_stopwords.
STOPWORDS = {
    "en": (
        "a an the and or but in on at to for of with "
        "is are was were be been being have has had do "
        "does did will would should could may might shall "
        "not no nor so yet both either neither each every "
        "all any few more most other some such than that "
        "this these those then also just from by as if "
        "up out about into through during before after above "
        "below between same very its it he she they we i "
        "my your his her our their what which who whom how "
        "when where why can cannot new like video watch "
        "subscribe channel youtube official full please"
    ).split(),
    "hi": (
        "और का की के है हैं में को से पर यह वह इस "
        "उस जो तो भी ने था थी हो कि एक लिए साथ वे "
        "कर हम आप मैं वो अब कब क्यों कहाँ जब बहुत "
        "करते करना किया किसी अपने उनके उनकी"
    ).split(),
    "te": (
        "మరియు లో కు తో ఈ అది ఉన్న చేసిన వారు నా మీ "
        "గా కి ని పై ఒక ఉంది అయిన చేయడం నుండి ఇది"
    ).split(),
    "ta": (
        "மற்றும் இல் உள் கள் என்று இது அது அந்த இந்த "
        "ஆக ஒரு என்ற உள்ளது வேண்டும் அவர் இவர்"
    ).split(),
    "kn": (
        "ಮತ್ತು ಇಲ್ಲಿ ಅದು ಇದು ಒಂದು ಅವರು ಮಾಡಿ ಇವರು ಆಗಿ "
        "ನಲ್ಲಿ ಅಥವಾ ಗೆ ದು ಕ್ಕೆ"
    ).split(),
    "ml": (
        "ഒരു ആണ് ഇത് അത് എന്ന ഈ ആ ഉണ്ട് ചെയ്ത കൂടി "
        "വരെ ആയ പറഞ്ഞ"
    ).split(),
    "bn": (
        "এবং এই এখন একটি হয় থেকে আছে সাথে করে কিন্তু "
        "সে তারা আমি আমাদের যে আর"
    ).split(),
    "mr": (
        "आणि हा ही हे ते तो ती मी आम्ही तुम्ही आहे "
        "होते करा एक काय कसे जे की"
    ).split(),
    "gu": (
        "અને આ તે છે કે હું તમે આપ એક ના ની ને "
        "માં પર સાથે હતી હતો હશે"
    ).split(),
    "pa": (
        "ਅਤੇ ਇਸ ਉਹ ਹੈ ਹਨ ਕਿ ਦੇ ਦੀ ਨੂੰ ਵਿੱਚ ਨਾਲ "
        "ਇੱਕ ਮੈਂ ਤੁਸੀਂ ਅਸੀਂ"
    ).split(),
    "ja": "の に は を た が で て と し れ さ ある いる も する から な こと".split(),
    "ko": "이 가 을 를 의 에 는 은 로 으로 도 만 과 와 한 하다 있다".split(),
    "zh": "的 了 在 是 我 有 和 就 不 人 都 一 一个 上 也 很 到 说 要 去".split(),
    "ar": "في من على إلى أن هذا هذه ما كان لا مع هو هي أو كل عن قد".split(),
    "fr": "le la les un une des et en à de du que qui est pour pas sur avec".split(),
    "de": "der die das und in zu den von mit ist des für auf im dem".split(),
    "es": "el la los las un una y en a de que es por con no lo como".split(),
    "pt": "o a os as um uma e em de que para com não por se".split(),
    "ru": "и в на не что это с как к он она они мы вы из по от за".split(),
    "id": "yang dan di ini itu dengan ke dari tidak ada untuk juga sudah bisa".split(),
    "tr": "ve bir bu da de için ile ya ama ne en gibi çok daha var".split(),
}

# The Unicode block that identifies each Indic script's language.
# Devanagari is shared by Hindi and Marathi and always reads as Hindi.
SCRIPT_BLOCKS = {
    "hi": (0x0900, 0x097F),
    "te": (0x0C00, 0x0C7F),
    "ta": (0x0B80, 0x0BFF),
    "kn": (0x0C80, 0x0CFF),
    "ml": (0x0D00, 0x0D7F),
    "bn": (0x0980, 0x09FF),
    "gu": (0x0A80, 0x0AFF),
    "pa": (0x0A00, 0x0A7F),
}

# Fixed value: fewest characters of one script that count as evidence of a language.
SCRIPT_MIN_CHARS = 3

# Unicode ranges kept by the punctuation filter besides word characters and blanks
# (Indic blocks, CJK ideographs, kana, Arabic).
KEPT_RANGES = ((0x0900, 0x0DFF), (0x4E00, 0x9FFF), (0x3040, 0x30FF), (0x0600, 0x06FF))

# Weekday names, Monday first.
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Quantiles that cut a metric into three classes.
TIER_QUANTILES = (0.33, 0.66)
