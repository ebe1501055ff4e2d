"""DataFrame operators. Import the module for the kind of work at hand."""
