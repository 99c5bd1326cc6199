"""Programme reporting on Spark: submissions in, metrics and a scorecard out.

Every operator is a function from DataFrame(s) to DataFrame; see the README
for the map from operator to module.
"""
