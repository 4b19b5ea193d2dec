"""Training-data operators over document corpora (one module per operator).

``queries`` maps every ``opN_<name>`` query to its function, ``oracle`` holds
the SQL of those that SQL can express; the rest of docflow never imports this
sub-package.
"""
