"""End-to-end plans made of operators: case assembly, realised results, nodal prices."""
