"""Fixed values of the dialogue rules.

These lists, tags, templates and thresholds are semantics: results depend on them, so they
are stated as they are.
"""

EMOTIONS = ("happy", "sad", "angry", "neutral")

# pool of many voices: emotion tags, prefixes used instead of them, sounds
POOL_TAGS = {"happy": ("amusement", "enthusiasm"), "sad": ("sadness",), "angry": ("anger",), "neutral": ()}
POOL_PREFIX = {
    "sad": "<|emotion:sadness|><|emotion:longing|><|prosody:pitch_low|><|prosody:speed_slow|><|prosody:expressive_high|>",
}
POOL_SOUNDS = {
    "happy": (("laughter", "Hahahaha"),),
    "sad": (("crying", "Aaahhh"), ("crying", "Ooohhh")),
    "angry": (("screaming", "Ahh"),),
}
MID_TURN = ("laughter", "crying")
SOUND_SHARE, MID_TURN_SHARE = 0.10, 0.40

# two fixed voices
PAIR_TAGS = {
    "happy": ("elation", "amusement", "enthusiasm"), "sad": ("sadness",), "angry": ("anger",), "neutral": ("contemplation",),
}
PAIR_SOUNDS = {
    "happy": (("laughter", "Haha"),),
    "sad": (("crying", ""), ("sigh", "Uh")),
    "angry": (("screaming", "Ahh"),),
}

# chat messages; {name} stands for a value
USER_MESSAGE = "Write one spoken user line.\nemotion={emotion}\ntopic={topic}\nvariety_seed={seed}"
AGENT_MESSAGE = (
    "User said: {user_text}\nUser emotion (for context only): {curr}\nYour reply emotion: {res}\nHow to reply: {hint}\n"
    "Remember: do not misread the valence of their message."
)

BANNED = ("as an ai", "here is", "here's a", "json", "<|", "emotion:", "i will write")
LEAST_CHARS, MOST_CHARS = 8, 280

USER_POSITIVE = (
    "great news", "good news", "promotion", "promoted", "won", "congratulations", "can't wait", "cannot wait",
    "so excited", "amazing", "awesome", "i got", "we got", "got accepted", "engaged", "married", "birthday", "celebrate",
)
USER_NEGATIVE = (
    "struggling", "hurts", "unfair", "lost", "fired", "broke up", "passed away", "dying", "hate", "awful", "terrible",
    "can't believe they", "so upset", "devastated",
)
AGENT_CONDOLENCE = (
    "sorry to hear", "i'm sorry to hear", "im sorry to hear", "that's terrible", "thats terrible", "that's awful",
    "thats awful", "that's so sad", "condolences", "my condolences",
)
AGENT_CONGRATS = (
    "congratulations", "congrats", "so happy for you", "thrilled for you", "that's amazing", "thats amazing",
    "that's wonderful", "thats wonderful",
)

HINTS = {
    ("happy", "happy"): "Match their excitement; celebrate with them.",
    ("happy", "sad"): "Keep their news as good news, but reply bittersweet about your own angle (e.g. you'll miss them). Never apologize as if their news were bad.",
    ("happy", "angry"): "Stay clear their news is good; reply with heat about a related unfairness — not at them.",
    ("happy", "neutral"): "Stay grounded; react practically or ask a light follow-up.",
    ("sad", "happy"): "Stay warm and encouraging without forcing cheerfulness onto their pain.",
    ("sad", "sad"): "Meet them gently; shared heaviness is enough.",
    ("sad", "angry"): "Reply with indignation on their behalf; don't congratulate the hardship.",
    ("sad", "neutral"): "Stay calm and open; a short check-in or question is fine.",
    ("angry", "happy"): "Offer a constructive bright side without dismissing the unfairness.",
    ("angry", "sad"): "Reply with quiet concern; shared weight, not pep talk.",
    ("angry", "angry"): "Share the heat about the unfairness; don't attack them.",
    ("angry", "neutral"): "Stay even; ask what happened or what they want to do next.",
    ("neutral", "happy"): "Brighten the reply with genuine enthusiasm about their point.",
    ("neutral", "sad"): "Reply subdued and caring; no forced cheer.",
    ("neutral", "angry"): "Push back firmly about unfairness in what they raised.",
    ("neutral", "neutral"): "Reply plain and natural.",
}
DEFAULT_HINT = "Reply in the requested emotion without misreading the valence of their message."

USER_FALLBACK = {
    "happy": "I just got great news about {topic}, I can't stop smiling.",
    "sad": "I've been struggling with {topic} lately, and it really hurts.",
    "angry": "I can't believe what happened with {topic}, it's so unfair.",
    "neutral": "I wanted to catch you up on {topic} when you have a minute.",
}
AGENT_FALLBACK = {
    ("happy", "happy"): "That's amazing, I'm so happy for you!",
    ("happy", "sad"): "I'm really happy for you, though it makes me a little sad knowing things will change.",
    ("happy", "angry"): "I'm glad you got that, though it still frustrates me how long they made you wait.",
    ("happy", "neutral"): "That's good news, what happens next for you?",
    ("sad", "happy"): "I'm sorry it's been hard, but I believe things can get better from here.",
    ("sad", "sad"): "That sounds really heavy, I'm here with you.",
    ("sad", "angry"): "That's not okay, it makes me angry they put you through that.",
    ("sad", "neutral"): "Thanks for telling me, do you want to talk about it?",
    ("angry", "happy"): "I get why you're upset, and I still think you've got a way through this.",
    ("angry", "sad"): "I hear how unfair that feels, and it honestly makes me sad too.",
    ("angry", "angry"): "You're right to be mad, that shouldn't have happened.",
    ("angry", "neutral"): "Okay, walk me through what happened.",
    ("neutral", "happy"): "Nice, that actually makes me pretty excited for you.",
    ("neutral", "sad"): "I hear you, and somehow that leaves me feeling a bit low.",
    ("neutral", "angry"): "That detail bothers me, it doesn't sound fair at all.",
    ("neutral", "neutral"): "Got it, tell me a bit more when you can.",
}
DEFAULT_AGENT_FALLBACK = "Thanks for sharing that, tell me a bit more when you're ready."

TEXT_PROMPT = "Answer with a {emotion} tone."
SPEAKER_AGENT, SPEAKER_USER = "SPEAKER_BROKER", "SPEAKER_CLIENT"
RETRY_NOTE = "\nBad example to avoid: saying 'sorry to hear that' after good news, or 'congratulations' after bad news."
