"""Taxonomies, lexicons and names the tagging results depend on.

Patterns are alternatives of whole words; the word edges are added where they are compiled.
"""

COMMON_ASPECTS = ("packaging", "quality", "price", "delivery", "customer_service")
TAXONOMY = {
    "Electronics": COMMON_ASPECTS + ("battery", "performance", "compatibility", "durability"),
    "Fashion": COMMON_ASPECTS + ("size_fit", "material", "design", "color", "durability"),
}

# One order that agrees with both domain lists.
ASPECTS = (
    "packaging", "quality", "price", "delivery", "customer_service", "battery", "performance",
    "compatibility", "size_fit", "material", "design", "color", "durability",
)

DISPLAY_NAMES = {
    "battery": "Battery & Charging",
    "performance": "Performance & Functionality",
    "compatibility": "Compatibility & Connection",
    "durability": "Durability & Build Quality",
    "size_fit": "Size & Fit",
    "material": "Material & Fabric",
    "design": "Design & Style",
    "color": "Color & Appearance",
    "packaging": "Packaging & Box Condition",
    "quality": "General Product Quality",
    "price": "Price & Value",
    "delivery": "Delivery & Shipping",
    "customer_service": "Customer Service & Returns",
}

VERBALIZATIONS = {
    "battery": "battery or charging",
    "performance": "performance or functionality",
    "compatibility": "compatibility or connection",
    "durability": "durability or breaking",
    "size_fit": "size and fit",
    "material": "material or fabric",
    "design": "design or style",
    "color": "color",
    "packaging": "packaging or box",
    "quality": "product quality",
    "price": "price or value",
    "delivery": "delivery or shipping",
    "customer_service": "customer service or return",
}

REVIEW_LEXICON = {
    "battery": (
        "batter(y|ies)", "charg(e|er|ing|ed)", "power", "drain(s|ed|ing)?", "die(s|d)?",
        "run time",
    ),
    "performance": (
        "slow|lag|laggy|freeze|freez(es|ing)|frozen|crash|crashes|reboot|restart|glitch",
        "volume|sound|audio|speaker|microphone|hear|loud|quiet",
        "speed|overheat|hot|unresponsive|buffering|stutter|stops working",
        "sporadic|unreliable|failed to work",
    ),
    "compatibility": (
        "compatib(le|ility)|incompatib(le|ility)",
        "connect|connection|disconnect|pairing|pair|bluetooth|wifi|wi-fi|sync|network",
        "hdmi|port|cable|adapter|usb|aux|jack|plug",
        "app|application|ios|android|mac|windows|tv|pc|iphone|ipad",
        "recogniz(e|ed)|detect(ed)?",
    ),
    "durability": (
        "durab(le|ility)|flimsy|sturdy|broke(n)?|snapped|crack(ed)?|shatter(ed)?",
        "died after|lasted|stopped working after|wear and tear|fell apart",
        "tear|tore|torn|rip|ripped|hole|fray(ed)?|seam split|unravel",
    ),
    "size_fit": (
        "size|sizing|fit|fits|fitted|tight|loose|small|smaller|large|larger|big|baggy",
        "length|waist|chest|inseam|shrink|shrunk|shrinking|true to size",
        "too short|too long|narrow|wide",
    ),
    "material": (
        "material|fabric|cotton|polyester|wool|linen|silk|leather|canvas",
        "thin|see through|sheer|rough|scratchy|itchy|soft|softness|breathab(le|ility)",
        "synthetic|blend|elastic|stretch(y)?",
    ),
    "design": (
        "design|style|look|looks|cute|ugly|cut|pattern|print|graphic",
        "pocket(s)?|zipper|button(s)?|seam|stitch(ing)?|collar|sleeve(s)?",
        "shape|appearance|aesthetic",
    ),
    "color": (
        "color|shade|fade(d)?|fading|dye|bleeding",
        "black|white|blue|red|green|yellow|pink|grey|gray|dark|bright",
        "washed out|discolor(ed)?|not the right color|wrong color",
    ),
    "packaging": (
        "packag(e|ing|ed)|box|boxed|bubble wrap|envelope|damaged box|seal(ed)?",
        "opened box|crushed box|unsealed",
    ),
    "quality": (
        "quality|cheap(ly)?|poor quality|low quality|junk|garbage|trash|terrible",
        "defective|defect|poorly made|subpar|waste of money|fake|counterfeit",
        "horrible|awful|disaster|shoddy",
    ),
    "price": (
        "price|pricing|cost|expensive|overpriced|cheap|worth|money|dollar|cent",
        "value for money|waste of money|overcharged|deal|rip off|ripoff",
    ),
    "delivery": (
        "deliver(y|ed)?|ship(ped|ping)?|arriv(e|ed|ing)|late|delayed|delay",
        "transit|tracking|lost in mail|carrier|on time",
    ),
    "customer_service": (
        "customer service|support|help desk|agent|representative",
        "return(ed|ing)?|refund(ed)?|exchange|warranty|guarantee|seller",
        "contacted|no response|refused",
    ),
}
# Substrings, not whole words: any of them makes an untagged review a quality complaint.
REVIEW_FALLBACK_WORDS = ("bad", "terrible", "awful", "horrible", "junk", "poor")

ANNOTATION_LEXICON = {
    "battery": (
        "battery|batteries|charge|charging|charger|drain|dies|died|holds charge|power bank",
    ),
    "performance": (
        "sound|audio|volume|bass|lag|laggy|slow|freeze|freezing|crash|glitch|speed|distort|"
        "muffled|static|buzz|screen|display|flicker|resolution|volume|hear|stream|buffering|"
        "touchscreen|remote",
    ),
    "compatibility": (
        "compatible|compatibility|connect|connecting|connection|bluetooth|wifi|wi-fi|sync|pair|"
        "pairing|adapter|port|usb|hdmi|ios|android|mac|pc|cable",
    ),
    "durability": (
        "durab|break|broke|broken|crack|cracked|stitching|shatter|fell apart|falling apart|tore|"
        "tear|snapped|peel|peeling|cheaply made|flimsy|fragile",
    ),
    "size_fit": (
        "size|sizing|fit|fits|fitting|tight|loose|small|smaller|large|larger|short|shorter|long|"
        "longer|waist|sleeves|shoulders|chest|snug|baggy|runs small|runs large|huge|tiny",
    ),
    "material": (
        "material|fabric|cotton|polyester|synthetic|wool|silk|linen|thin|see through|see-through|"
        "rough|scratchy|itchy|softness|wrinkle|wrinkles|breathable",
    ),
    "design": (
        "design|style|cut|shape|pattern|pockets|zipper|buttons|collar|look|looks|ugly|flattering|"
        "unflattering",
    ),
    "color": (
        "color|colors|colour|shade|faded|fading|bleeding|dye|picture|photo|yellow|blue|red|black|"
        "white|darker|lighter|not as pictured|different color",
    ),
    "packaging": (
        "packag|box|package|boxed|bubble wrap|envelope|unopened|seal|dented|damaged box|open box",
    ),
    "quality": (
        "quality|junk|garbage|trash|waste|poor|terrible|horrible|defective|cheap|worthless|shoddy|"
        "crap",
    ),
    "price": (
        "price|pricing|cost|dollar|dollars|expensive|overpriced|value|money|worth it|"
        "waste of money|rip off|ripoff",
    ),
    "delivery": (
        "deliver|delivery|ship|shipping|shipped|carrier|mail|arrived|late|transit|tracking|lost",
    ),
    "customer_service": (
        "customer service|support|seller|return|returns|returned|refund|refunded|warranty|"
        "replacement|rep",
    ),
}
# Substrings that always add quality.
ANNOTATION_QUALITY_WORDS = ("junk", "trash", "garbage", "poor", "waste", "cheaply")

COMPLAINT_SIGNALS = (
    "unhappy", "complaint", "complaints", "issue", "issues", "problem", "problems",
    "worst", "hate", "hated", "bad", "drawback", "drawbacks", "poor", "fault",
    "defect", "defects", "fail", "fails", "failed", "broken", "disappointed",
    "disappointing", "negative", "sucks", "terrible", "awful", "return", "returned",
    "useless", "flaw", "flaws", "trouble", "warning", "wrong", "annoying", "annoyed",
)
PRAISE_SIGNALS = (
    "like", "likes", "liked", "love", "loves", "loved", "best", "great", "good",
    "praise", "praises", "recommend", "recommended", "pros", "advantage",
    "advantages", "favorite", "positive", "enjoy", "enjoyed", "awesome",
    "excellent", "happy", "impressive", "satisfied", "pleased",
)
