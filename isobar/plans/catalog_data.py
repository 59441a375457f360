"""The catalog of products and forecast models, as text."""

#: code | units | class | expression over the inputs A, B, ... | knobs
PRODUCTS = """
refc|dBZ|single|A|
t2m|degF|single|A*1.8D+32|
td2m|degF|single|A*1.8D+32|
wind10m|kt|uv|sqrt(A*A+B*B)*1.94384D|
pm25|µg/m³|single|A|
pm10c|µg/m³|single|A|
ozoneC|µg/m³|single|A|
no2C|µg/m³|single|A|
dustC|µg/m³|single|A|
popPrecip|%|single|A|
popSnow|%|single|A|
waveHgt|ft|single|A*3.28084D|
swellHgt|ft|single|A*3.28084D|
wavePeriod|s|single|A|
wind10mS|kt|single|A*1.94384D|
gust10m|kt|single|A*1.94384D|
mslp|hPa|single|A/100.0D|
sfccape|J/kg|single|A|
precip1h|in|single|A/25.4D|
precip15m|in|single|A/25.4D|
snow15m|in|single|A*0.393701D|
capeMU|J/kg|single|A|
tccF|%|single|A|
lccF|%|single|A|
mccF|%|single|A|
hccF|%|single|A|
precipTotalM|in|single|A*39.3701D|
precip3h|in|single|A/25.4D|fh_min=3 fh_step=3
precip6h|in|single|A/25.4D|fh_min=6 fh_step=6
wind925|kt|uv|sqrt(A*A+B*B)*1.94384D|
wind850|kt|uv|sqrt(A*A+B*B)*1.94384D|
wind700|kt|uv|sqrt(A*A+B*B)*1.94384D|
wind300|kt|uv|sqrt(A*A+B*B)*1.94384D|
wind250|kt|uv|sqrt(A*A+B*B)*1.94384D|
wind200|kt|uv|sqrt(A*A+B*B)*1.94384D|
rh925|%|single|A|
rh850|%|single|A|
rh700|%|single|A|
rh500|%|single|A|
vort500|10⁻⁵/s|single|A*100000.0D|
vv700|Pa/s|single|A|
vv850|Pa/s|single|A|
capeML180|J/kg|single|A|
cinML180|J/kg|single|A|
shearSfc500|kt|derived|sqrt((C-A)*(C-A)+(D-B)*(D-B))*1.94384D|
wind500|kt|uv|sqrt(A*A+B*B)*1.94384D|
precipTotal|in|single|A/25.4D|fh_min=1
tcc|%|single|A|
lcc|%|single|A|
mcc|%|single|A|
hcc|%|single|A|
refd1km|dBZ|single|A|
irsat|K|single|A|
smokesfc|µg/m³|single|A*1000000000.0D|
smokeint|mg/m²|single|A*1000000.0D|
ltng|fl/km²|single|A|fh_min=1
sbcin|J/kg|single|A|
capeML|J/kg|single|A|
cinML|J/kg|single|A|
lpi|J/kg|single|A|
updraft|m/s|single|A|
uh25|m²/s²|single|A|fh_min=1
snod|in|single|A*39.3701D|
asnow|in|single|A*39.3701D|fh_min=1
frzr|in|single|A/25.4D|fh_min=1
mlcape|J/kg|single|A|
mucape|J/kg|single|A|
mlcin|J/kg|single|A|
srh1|m²/s²|single|A|
srh3|m²/s²|single|A|
shear6|kt|uv|sqrt(A*A+B*B)*1.94384D|
stp|-|derived|greatest((A/1500.0D)*least(greatest((2000.0D-(C-D))/1000.0D,0.0D),1.0D)*(E/150.0D)*if(sqrt(F*F+G*G)<12.5D,0.0D,least(sqrt(F*F+G*G),30.0D)/20.0D)*least(greatest((200.0D+B)/150.0D,0.0D),1.0D),0.0D)|
scp|-|derived|greatest((A/1000.0D)*(B/50.0D)*if(sqrt(C*C+D*D)<10.0D,0.0D,least(sqrt(C*C+D*D),20.0D)/20.0D),0.0D)|
cape3km|J/kg|single|A|
liftedIdx|°C|single|A|
lapse75|°C/km|derived|(A-B)/greatest((C-D)/1000.0D,0.1D)|
lclHgt|m|derived|greatest(A-B,0.0D)|
shear1|kt|uv|sqrt(A*A+B*B)*1.94384D|
stormMotion|kt|uv|sqrt(A*A+B*B)*1.94384D|
ehi1|-|derived|greatest((A*B)/160000.0D,0.0D)|
ehi3|-|derived|greatest((A*B)/160000.0D,0.0D)|
pwat|in|single|A/25.4D|
echoTops|kft|single|A*0.00328084D|
ptype|-|derived|if(D>0,4,if(C>0,3,if(B>0,2,if(A>0,1,0))))|fh_min=1 resample=near
ptype15|-|derived|if(D>0,4,if(C>0,3,if(B>0,2,if(A>0,1,0))))|fh_min=15 fh_cap=1080 resample=near
ptypeRefl|dBZ|derived|100*A+least(greatest(B,0.0D),75.0D)|fh_min=1
ptypeRefl15|dBZ|derived|100*A+least(greatest(B,0.0D),75.0D)|fh_min=15 fh_cap=1080
frzLvl|m|single|A|
rh2m|%|single|A|
vis|mi|single|A/1609.34D|
thetae|K|single||
qpe01h|in|mrms-qpe|A/25.4D|
qpe03h|in|mrms-qpe|A/25.4D|
qpe06h|in|mrms-qpe|A/25.4D|
qpe12h|in|mrms-qpe|A/25.4D|
qpe24h|in|mrms-qpe|A/25.4D|
mesh|in|mrms|A*0.0393701D|resample=max
mesh60|in|mrms|A*0.0393701D|resample=max
mesh240|in|mrms|A*0.0393701D|resample=max
mesh1440|in|mrms|A*0.0393701D|resample=max
posh|%|mrms|A|resample=max
et18|kft|mrms|A*3.28084D|resample=max
et30|kft|mrms|A*3.28084D|resample=max
et50|kft|mrms|A*3.28084D|resample=max
et60|kft|mrms|A*3.28084D|resample=max
vil|kg/m²|mrms|A|resample=max
vild|g/m³|mrms|A|resample=max
vii|kg/m²|mrms|A|resample=max
rot30|s⁻¹|mrms|A*0.001D|resample=max
rot60|s⁻¹|mrms|A*0.001D|resample=max
rot240|s⁻¹|mrms|A*0.001D|resample=max
rot1440|s⁻¹|mrms|A*0.001D|resample=max
soilsat|%|mrms|A|
unitq|m³/s/km²|mrms|A|
ari01h|yr|mrms|A|
arimax|yr|mrms|A|
ffg01h|x FFG|mrms|A*0.01D|
ffgmax|x FFG|mrms|A*0.01D|
rate|in/hr|mrms|A*0.0393701D|
rq15m|in|mrms|A*0.0393701D|
rq01h|in|mrms|A*0.0393701D|
rq03h|in|mrms|A*0.0393701D|
rq06h|in|mrms|A*0.0393701D|
rq12h|in|mrms|A*0.0393701D|
rq24h|in|mrms|A*0.0393701D|
rq48h|in|mrms|A*0.0393701D|
rq72h|in|mrms|A*0.0393701D|
rq12z|in|mrms|A*0.0393701D|
ms01h1|in|mrms|A*0.0393701D|
ms01h2|in|mrms|A*0.0393701D|
ms03h1|in|mrms|A*0.0393701D|
ms03h2|in|mrms|A*0.0393701D|
ms06h1|in|mrms|A*0.0393701D|
ms06h2|in|mrms|A*0.0393701D|
ms12h1|in|mrms|A*0.0393701D|
ms12h2|in|mrms|A*0.0393701D|
ms24h1|in|mrms|A*0.0393701D|
ms24h2|in|mrms|A*0.0393701D|
ms48h1|in|mrms|A*0.0393701D|
ms48h2|in|mrms|A*0.0393701D|
ms72h1|in|mrms|A*0.0393701D|
ms72h2|in|mrms|A*0.0393701D|
streamflow|m³/s|mrms|A|
sacsoil|%|mrms|A|
sacflow|m³/s|mrms|A|
sacunitq|m³/s/km²|mrms|A|
hpflow|m³/s|mrms|A|
hpunitq|m³/s/km²|mrms|A|
ari30m|yr|mrms|A|
ari03h|yr|mrms|A|
ari06h|yr|mrms|A|
ari12h|yr|mrms|A|
ari24h|yr|mrms|A|
ffg03h|x FFG|mrms|A*0.01D|
ffg06h|x FFG|mrms|A*0.01D|
rala|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
brefqc|dBZ|mrms|A|sentinel_lt=-35.0
lcrlow|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
lcrhigh|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
lcrsuper|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
refl0c|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
reflm5c|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
reflm10c|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
reflm15c|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
reflm20c|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
crefmax1h|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
brefmax1h|dBZ|mrms|A|sentinel_lt=-35.0 resample=max
reflhgt|kft|mrms|A*0.00328084D|
shi|-|mrms|A|resample=max
mesh30|in|mrms|A*0.0393701D|resample=max
mesh120|in|mrms|A*0.0393701D|resample=max
mesh360|in|mrms|A*0.0393701D|resample=max
vilsw120|kg/m²|mrms|A|resample=max
vilsw1440|kg/m²|mrms|A|resample=max
rotnow|s⁻¹|mrms|A*0.001D|sentinel_lt=-1.0 resample=max
rot120|s⁻¹|mrms|A*0.001D|resample=max
rot360|s⁻¹|mrms|A*0.001D|resample=max
rotmlnow|s⁻¹|mrms|A*0.001D|sentinel_lt=-1.0 resample=max
rotml30|s⁻¹|mrms|A*0.001D|resample=max
rotml60|s⁻¹|mrms|A*0.001D|resample=max
rotml120|s⁻¹|mrms|A*0.001D|resample=max
rotml240|s⁻¹|mrms|A*0.001D|resample=max
rotml360|s⁻¹|mrms|A*0.001D|resample=max
rotml1440|s⁻¹|mrms|A*0.001D|resample=max
probRefc40|%|single|A|fh_min=1
probUh25|%|single|A|fh_min=1
probUh75|%|single|A|fh_min=1
probRain05|%|single|A|
probRain1|%|single|A|
probWind40|%|single|A|fh_min=1
probSnow1h|%|single|A|
probCape2k|%|single|A|fh_min=1
"""

#: model | calendar | west,south,east,north | runs kept
MODELS = """
HRRR|0..18/1; syn 0..48/1 at [0, 6, 12, 18]|-134.0,21.0,-60.0,53.0|5
RRFS|0..18/1; syn 0..84/1 at [0, 6, 12, 18]|-134.0,21.0,-60.0,53.0|5
OBS|0..0/1|-130.0,20.0,-60.0,55.0|26
RTMA|0..0/1|-134.0,21.0,-60.0,53.0|12
ECMWF|seg 0..144/3 + 150..240/6|-134.0,21.0,-60.0,53.0|4
AIFS|0..360/6|-134.0,21.0,-60.0,53.0|4
GEFS|0..384/6|-134.0,21.0,-60.0,53.0|4
ICOND2|0..48/1|-3.94,43.18,20.34,58.08|5
AIGFS|6..384/6|-134.0,21.0,-60.0,53.0|4
GFS013|seg 0..120/1 + 123..384/3|-134.0,21.0,-60.0,53.0|4
UKMO|seg 0..54/1 + 57..60/3|-134.0,21.0,-60.0,53.0|4
GDPS|seg 0..84/1 + 87..240/3|-134.0,21.0,-60.0,53.0|4
HGEFS|6..240/6|-134.0,21.0,-60.0,53.0|4
NBM|seg 1..36/1 + 39..189/3 + 195..261/6|-126.28,19.23,-59.04,54.37|4
HRDPS|0..48/1|-141.0,38.0,-52.0,70.0|4
RDPS|0..84/1|-140.0,18.0,-50.0,62.0|4
KNMIHAR|0..60/1|-15.0,42.0,25.0,62.0|4
DMIHAR|0..59/1|-15.0,42.0,25.0,62.0|4
UKV|0..12/1|-11.0,48.0,5.0,61.0|4
ALADIN|0..72/1|2.0,40.0,33.0,56.0|4
ICONCH1|0..33/1|1.23,42.58,16.85,49.79|4
ICONCH2|0..120/1|1.23,42.58,16.85,49.79|3
METNO|0..57/1|2.0,53.0,40.0,72.0|4
AROMEHD|0..51/1|-12.0,37.5,16.0,55.4|4
CAMSEU|0..96/1|-25.0,30.0,45.0,72.0|2
CAMSGL|0..120/1|-134.0,21.0,-60.0,53.0|2
ICON|seg 0..78/1 + 81..180/3|-134.0,21.0,-60.0,53.0|4
ICONEU|seg 0..78/1 + 81..120/3|-23.5,29.5,62.5,70.5|4
AROMEFR|0..51/1|-12.0,37.5,16.0,55.4|4
ARPEGE|seg 0..48/1 + 51..102/3|-134.0,21.0,-60.0,53.0|4
ARPEGEEU|0..102/1|-32.0,20.0,42.0,72.0|4
ICON2I|0..72/1|3.0,33.7,22.0,48.9|3
AROMEAT|0..60/1|5.498,42.981,22.102,51.819|4
JMAMSM|0..39/1|120.0,22.4,150.0,47.6|4
JMAGSM|0..132/6|100.0,5.0,170.0,50.0|4
CMA|0..120/3|-134.0,21.0,-60.0,53.0|4
GFSWAVE|seg 0..120/1 + 123..384/3|-134.0,21.0,-60.0,53.0|4
ECMWFWAM|0..144/3|-134.0,21.0,-60.0,53.0|4
GWAM|0..174/3|-134.0,21.0,-60.0,53.0|3
GFS|seg 0..120/3 + 126..384/6|-134.0,21.0,-60.0,53.0|5
HRRR15|min 0..1125/15|-134.0,21.0,-60.0,53.0|3
RRFS15|min 15..1080/15|-134.0,21.0,-60.0,53.0|5
AROMEFR15|min 15..360/15|-12.0,37.5,16.0,55.4|4
RAP|0..21/1; syn 0..51/1 at [3, 9, 15, 21]|-134.0,21.0,-60.0,53.0|5
REFSPMMN|1..60/1|-134.0,21.0,-60.0,53.0|4
REFSPROB|1..60/1|-134.0,21.0,-60.0,53.0|4
"""
