"""Expected values of the four-node example: ranks per iteration and metrics."""

# Fixed values.
EDGE_LINES = ["A\tB", "A\tC", "A\tD", "B\tC", "C\tA", "C\tD", "D\t"]
ADJACENCY_LINES = ["A\tB,C,D", "B\tC", "C\tA,D", "D\t"]
IDS = ("A", "B", "C", "D")
RANKS = [
    (0.196875000000000, 0.161458333333333, 0.373958333333333, 0.267708333333333),
    (0.253320312500000, 0.150169270833333, 0.287408854166666, 0.309101562500000),
    (0.225332845052083, 0.174958170572917, 0.302602050781250, 0.297106933593750),
    (0.229241094970703, 0.164479529486762, 0.313193974473741, 0.293085401068793),
    (0.232888086878458, 0.164732291302151, 0.304539891365899, 0.297839730453491),
    (0.230220396551873, 0.166775900670263, 0.306798348277091, 0.296205354500770),
    (0.230832935849178, 0.165672750187778, 0.307432265757501, 0.296062048205542),
    (0.231071898190615, 0.165815850400945, 0.306637688060556, 0.296474563347882),
    (0.230821862137161, 0.165971215865432, 0.306914688706236, 0.296292233291169),
    (0.230900842274524, 0.165861627179902, 0.306937160665520, 0.296300369880053),
    (0.230912121882357, 0.165885733910626, 0.306868117013543, 0.296334027193472),
    (0.230889930509368, 0.165896081978614, 0.306898955802646, 0.296315031709369),
    (0.230899000454365, 0.165885757882562, 0.306897427564383, 0.296317814098686),
    (0.230898942210833, 0.165888918958041, 0.306891813158218, 0.296320325672903),
    (0.230897089797735, 0.165889436165228, 0.306895017279563, 0.296318456757471),
    (0.230898054404776, 0.165888514170321, 0.306894534910765, 0.296318896514135),
]
# iteration: largest change, average change
DELTAS = {
    2: (8.654947916666700e-02, 4.891927083333349e-02),
    3: (2.798746744791697e-02, 1.999104817708373e-02),
    8: (7.945776969449647e-04, 3.972888484722464e-04),
    15: (3.204121344968502e-06, 1.860664265503076e-06),
    16: (9.646070410207486e-07, 7.021818525035362e-07),
}
TOP = ["C", "D", "A", "B"]
