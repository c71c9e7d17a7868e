"""Training-data operators: each module holds one operator; ``queries`` binds
them to the test tables.  Nothing else in the package imports this one."""
