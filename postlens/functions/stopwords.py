"""Stop words of the word-frequency report."""

# Words kept out of the most-frequent-words report.
REPORT_STOP_WORDS = (
    # articles, prepositions, adverbs of place and time
    "the", "a", "an", "and", "or", "but", "if", "because", "as", "what",
    "when", "where", "how", "which", "who", "whom", "why", "from", "to",
    "of", "in", "on", "at", "by", "for", "with", "about", "into", "through",
    "during", "before", "after", "above", "below", "up", "down", "out", "off",
    "over", "under", "again", "further", "then", "once", "here", "there",
    # verbs
    "is", "are", "was", "were", "be", "been", "being", "am", "im", "ive",
    "have", "has", "had", "having", "do", "does", "did", "doing",
    "can", "could", "shall", "should", "will", "would", "may", "might", "must",
    # pronouns
    "i", "me", "my", "we", "our", "ours", "ourselves",
    "you", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "this", "that", "these", "those",
    # words of little content
    "just", "really", "very", "so", "like", "much", "many", "some", "any", "no", "not",
    "only", "own", "same", "too", "than", "also", "even", "back", "get", "go", "going", "got",
    "well", "way", "made", "make", "know", "think", "thing", "things", "see", "say", "said",
    "want", "good", "better", "best", "still", "never", "ever", "last",
    "right", "left", "sure", "actually", "maybe", "probably", "one", "two", "people",
    "someone", "something", "time", "years", "day", "days", "life", "look", "use",
    "all", "more", "now", "first", "since", "while", "lot", "little", "few", "take",
    # traces of the web
    "http", "https", "www", "com", "reddit", "subreddit", "post", "posts", "comment", "comments",
    "img", "png", "jpg", "html", "php", "url", "link", "deleted", "removed", "org",
    # parts of contractions
    "don", "didn", "doesn", "isn", "wasn", "weren", "hasn", "haven", "hadn",
    "won", "wouldn", "couldn", "shouldn", "cant", "cannot", "wont", "arent",
)
