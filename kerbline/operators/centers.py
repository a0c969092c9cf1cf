"""Reference centres used by fixed-model reports and checks."""

# Fixed values: (clat, clon) of clusters 0 to 19.
CITY_CENTERS = [
    (40.72660911077645, -73.98917232981626),
    (40.64609765799116, -73.78281491758385),
    (40.7428946145125, -73.66358276643993),
    (40.19553862275448, -74.03982005988026),
    (40.74418245292011, -73.99834543927251),
    (40.66769131453637, -73.97867328344304),
    (40.80071083453548, -73.96131403667823),
    (40.769246277712085, -73.87431772462058),
    (40.76908312435993, -73.95108637160125),
    (41.00137756892232, -73.77536403508782),
    (40.76951074481075, -73.47011953601952),
    (40.69526321994591, -74.17986948202577),
    (40.86046186462323, -73.91194975734356),
    (40.800159722222205, -73.09867175925925),
    (40.70833049181757, -73.94646767902005),
    (40.572881939799316, -74.41083946488294),
    (40.86541329561527, -74.2499240452617),
    (40.75975852142163, -73.97945721301947),
    (40.7288231603198, -73.83419447079568),
    (40.71562093935289, -74.00870020550346),
]
